"""Secret scans over an incremental ledger of blobs.

Every version of every text is named by the SHA-256 of its bytes. The ledger, a table that grows
by one part per run, says which rules (with their version) have read which blob and what they
found. A run reads one copy of each blob that some rule has not read yet, with just those rules,
adds the findings, and joins them back to all paths that hold the blob.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from srcsieve.llm.common import texts
from srcsieve.operators.joins import attach_group
from srcsieve.session import materialise


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has ``least`` characters or more."""

    kind: str
    version: int
    pattern: str
    least: int = 0
    group: int = 0
    flags: int = re.ASCII

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"

    def find(self, text: str) -> Iterator[tuple[int, int]]:
        for match in re.compile(self.pattern, self.flags).finditer(text):
            if match.end(self.group) - match.start(self.group) >= self.least:
                yield match.span()


#: Fixed patterns; the first three are the base kinds. Runs of hex digits are looked for at their
#: least length at once, which finds the same runs.
BASE = (
    Rule(
        "assign", 1,
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=8, group=2, flags=re.ASCII | re.IGNORECASE,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", least=16),
    Rule("hex", 1, r"[0-9a-f]{32,}", least=32),
)
RULES = (
    *BASE,
    Rule("private_key", 1, r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("web_token", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("forge_token", 1, r"\bgh[opsru]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", 1, r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("url_login", 1, r"\b[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,100}:[^\s/:@]{1,100}@"),
)
#: A rule whose matches hold one of these strings reads only texts that hold it too.
_MARKS = {"access": "AKIA", "private_key": "PRIVATE KEY", "web_token": "eyJ", "forge_token": "gh", "chat_token": "xox", "url_login": "://"}
#: A finding names its rule with the version; ranks are those of the rules a run asks for.
LEDGER = "blob binary, rules array<string>, findings array<struct<start:int,rule:string,end:int>>"


def _scanner(rules: tuple[Rule, ...]):
    by_name = {rule.name: rule for rule in rules}
    kind = pa.list_(pa.struct([("start", pa.int32()), ("rule", pa.string()), ("end", pa.int32())]))

    def scan(text: str, names: list[str]) -> list[dict]:
        found = []
        for name in names:
            rule = by_name[name]
            if _MARKS.get(rule.kind, "") in text:
                found += [{"start": a, "rule": name, "end": b} for a, b in rule.find(text)]
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs, wanted, whole = (batch.column(i) for i in range(3))
            found = [scan(text, names) for text, names in zip(whole.to_pylist(), wanted.to_pylist())]
            yield pa.RecordBatch.from_arrays([blobs, wanted, pa.array(found, type=kind)], names=["blob", "rules", "findings"])

    return run


def read_ledger(docs: DataFrame, ledger_path: str) -> DataFrame:
    """``(blob, rules, findings)``, one row per blob that some run has read."""
    spark = docs.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(ledger_path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], LEDGER)
    # One row per blob and run: bounded by the rule versions there ever were.
    return (
        spark.read.schema(LEDGER).parquet(ledger_path)
        # Parts written before findings named their rule: what has such findings is read again.
        .where(~F.exists("findings", lambda f: f["rule"].isNull()))
        .groupBy("blob")
        .agg(F.flatten(F.collect_list("rules")).alias("rules"), F.flatten(F.collect_list("findings")).alias("findings"))
    )


def scan_secrets(
    docs: DataFrame,
    ledger_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """``(id_col, blob, findings)`` of every row; the ledger at ``ledger_path`` grows by what was unseen.

    Findings are ``(start, rank, kind, end)`` in code points, end exclusive, by start and then in
    the order of ``rules``; those of rule versions not asked for stay in the ledger only. A null text
    is an empty blob. Null ids and repeated rows each come back, other columns are dropped. A run
    that dies before its part is written leaves the ledger as it was.
    """
    source = texts(docs, id_col, text_col)
    blob = F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("blob")
    paths = materialise(source.select(id_col, blob), "paths")
    blobs = paths.groupBy("blob").agg(F.min(id_col).alias("holder"), F.count(F.lit(1)).alias("paths"))
    blobs = materialise(blobs, "blobs")
    names = F.array(*[F.lit(rule.name) for rule in rules])
    seen = read_ledger(docs, ledger_path).select("blob", "rules")
    wanted = F.array_except(names, F.coalesce("rules", F.array().cast("array<string>")))
    unseen = blobs.join(seen, "blob", "left").select("blob", "holder", wanted.alias("wanted")).where(F.size("wanted") > 0)
    versions = source.select(F.col(id_col).alias("_id"), blob.alias("_blob"), "text")
    # Keyed by blob and holder, so the copies of a hot blob do not meet in one task.
    read = versions.join(
        unseen, (F.col("_blob") == unseen["blob"]) & F.col("_id").eqNullSafe(unseen["holder"])
    ).select("blob", "wanted", "text")
    scanned = read.mapInArrow(_scanner(rules), LEDGER).dropDuplicates(["blob"])
    scanned.write.mode("append").parquet(ledger_path)
    known = read_ledger(docs, ledger_path).select("blob", "findings")
    kinds = F.create_map(*[F.lit(v) for rule in rules for v in (rule.name, rule.kind)])
    asked = F.transform(
        F.filter("findings", lambda f: f["rule"].isin([rule.name for rule in rules])),
        lambda f: F.struct(
            f["start"].alias("start"), (F.array_position(names, f["rule"]) - 1).cast("int").alias("rank"),
            kinds[f["rule"]].alias("kind"), f["end"].alias("end"),
        ),
    )
    sized = blobs.select("blob", "paths").join(known, "blob").select("blob", "paths", F.sort_array(asked).alias("findings"))
    return attach_group(paths, sized, ["blob"], "paths").select(id_col, "blob", "findings")


def listed(findings: Column) -> Column:
    """``kind:start:end`` of each finding, comma-joined."""
    return F.array_join(
        F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ","
    )
