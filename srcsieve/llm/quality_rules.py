"""Quality rules as a learned decision list, native from the texts to the verdict.

Sequential covering on labelled statistics: a rule is a conjunction of thresholds that is grown
on one part of the labelled rows and pruned on the other; what it covers leaves both parts and
the next rule is sought. The list becomes one ordered conditional expression.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame, functions as F

from srcsieve.llm.common import in_fold
from srcsieve.llm.text_stats import COUNTS, features, with_counts
from srcsieve.operators.joins import lookup_join
from srcsieve.session import materialise

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20


@dataclass(frozen=True)
class Condition:
    """``feature >= threshold`` if ``above``, else ``feature < threshold``."""

    feature: str
    above: bool
    threshold: float

    def column(self, columns: dict[str, Column]) -> Column:
        value = columns[self.feature]
        return value >= F.lit(self.threshold) if self.above else value < F.lit(self.threshold)


Rule = tuple[Condition, ...]


def _all(rule: Rule, columns: dict[str, Column]) -> Column:
    verdict = F.lit(True)
    for condition in rule:
        verdict = verdict & condition.column(columns)
    return verdict


def decision(rules: list[Rule], columns: dict[str, Column]) -> Column:
    """The number, from 1, of the first rule that rejects; 0 where none does."""
    chain = F.lit(0)
    for number in range(len(rules), 0, -1):
        chain = F.when(_all(rules[number - 1], columns), F.lit(number)).otherwise(chain)
    return chain


def base_failed(count) -> Column:
    """Too few words, or too many of them in repeated windows."""
    repeats = count("n_repeat_words") * 100 > count("n_words") * MAX_REPEAT_PERCENT
    return (count("n_words") < MIN_WORDS) | repeats


def quality_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, *COUNTS)`` of every row."""
    narrow = docs.select(docs[id_col].alias(id_col), docs[text_col].alias("text"))
    return with_counts(narrow, F.col("text")).select(id_col, "_counts.*")


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    """Information gained by the ``p`` rejects kept when ``p0, n0`` shrink to ``p, n``."""
    return p * (log2(p / (p + n)) - log2(p0 / (p0 + n0))) if p and p0 else 0.0


class _Learner:
    """The labelled rows with a bin per feature, and the covering steps over them."""

    def __init__(self, rows: DataFrame, names: list[str], bins: int) -> None:
        quantiles = [i / bins for i in range(1, bins)]
        cuts = rows.agg(*[F.percentile_approx(f, quantiles, 10_000).alias(f) for f in names]).first()
        self.cuts = {f: sorted(set(cuts[f] or [])) for f in names}
        self.names = names
        binned = [sum(((F.col(f) >= t).cast("int") for t in self.cuts[f]), F.lit(0)).alias(f) for f in names]
        self.rows = materialise(rows.select("bad", "growing", *binned), "labelled-bins")

    def columns(self) -> dict[str, Column]:
        return {f: F.col(f) for f in self.names}

    def histogram(self, rows: DataFrame) -> list:
        """Rejects and others per feature and bin: a few hundred rows at any size."""
        cells = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("bin")) for f in self.names]))
        return (
            rows.select("bad", cells.alias("cell"))
            .groupBy("cell.f", "cell.bin")
            .agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n"))
            .collect()
        )

    def best(self, rows: DataFrame) -> tuple[Condition, int, int] | None:
        """The condition, on bins, with the largest gain, and what it covers."""
        table: dict[str, dict[int, tuple[int, int]]] = {f: {} for f in self.names}
        for cell in self.histogram(rows):
            table[cell["f"]][cell["bin"]] = (cell["p"], cell["n"])
        found, most = None, 0.0
        for f in self.names:
            p0, n0 = (sum(v[i] for v in table[f].values()) for i in (0, 1))
            for t in range(1, len(self.cuts[f]) + 1):
                p, n = (sum(v[i] for b, v in table[f].items() if b >= t) for i in (0, 1))
                for above, (cp, cn) in ((True, (p, n)), (False, (p0 - p, n0 - n))):
                    gain = _gain(cp, cn, p0, n0)
                    if gain > most + 1e-9:
                        found, most = (Condition(f, above, t), cp, cn), gain
        return found

    def grow(self, rows: DataFrame, max_conditions: int) -> Rule:
        rule: Rule = ()
        while len(rule) < max_conditions:
            step = self.best(rows)
            if step is None:
                break
            condition, _, others = step
            rule += (condition,)
            rows = rows.where(condition.column(self.columns()))
            if others == 0:
                break
        return rule

    def prune(self, rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
        """The prefix of ``rule`` with the best ``(p - n) / (p + n)`` and what it covers."""
        counts = []
        for size in range(1, len(rule) + 1):
            hit = _all(rule[:size], self.columns())
            counts += [F.count_if(hit & F.col("bad")), F.count_if(hit & ~F.col("bad"))]
        row = rows.agg(*[c.alias(f"c{i}") for i, c in enumerate(counts)]).first()
        covers = [(row[2 * i], row[2 * i + 1]) for i in range(len(rule))]
        worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in covers]
        at = worth.index(max(worth))
        return rule[: at + 1], *covers[at]

    def on_values(self, rule: Rule) -> Rule:
        """``rule`` with its bins turned back into thresholds on the features."""
        return tuple(Condition(c.feature, c.above, float(self.cuts[c.feature][int(c.threshold) - 1])) for c in rule)


def learn_rules(
    rows: DataFrame,
    max_rules: int = 8,
    max_conditions: int = 3,
    bins: int = 32,
    min_precision: float = 0.9,
    min_covered: int = 5,
) -> list[Rule]:
    """A decision list from ``rows``: a boolean ``bad``, a boolean ``growing`` and features.

    Every labelled row counts. Each step aggregates the rows to a histogram of at most
    ``features * bins`` cells, which is all that reaches the driver. A rule must cover
    ``min_covered`` pruning rows with ``min_precision`` rejects among them. No labelled row,
    or no reject among them, gives no rule.
    """
    names = [c for c in rows.columns if c not in ("bad", "growing")]
    learner = _Learner(rows, names, bins)
    left, rules = learner.rows, []
    for _ in range(max_rules):
        rule = learner.grow(left.where("growing"), max_conditions)
        if not rule:
            break
        rule, p, n = learner.prune(left.where("NOT growing"), rule)
        if p < min_covered or p < min_precision * (p + n):
            break
        rules.append(learner.on_values(rule))
        left = left.where(~_all(rule, learner.columns()))
    return rules


def known_labels(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id_col, quality)`` to learn from: one row per id outside the held-out fold.

    Of repeated labels the smallest counts; null labels do not.
    """
    return (
        labels.select(labels[id_col].alias(id_col), labels["quality"].alias("quality"))
        .where(F.col("quality").isNotNull() & ~in_fold(F.col(id_col)))
        .groupBy(id_col)
        .agg(F.min("quality").alias("quality"))
    )


def labelled(counts: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows to learn from: the label, the growing part and the features of labelled documents.

    Rows that the base rules reject anyway are left out.
    """
    columns = [c.alias(name) for name, c in features(F.col).items()]
    part = F.pmod(F.xxhash64(id_col), F.lit(3)) != 0
    return counts.where(~base_failed(F.col)).join(known_labels(labels, id_col), id_col).select(
        (F.col("quality") == 0).alias("bad"), part.alias("growing"), *columns
    )


def judge(counts: DataFrame, rules: list[Rule]) -> DataFrame:
    """``counts`` with ``base_failed``, the number of the ``rule`` that rejects, and ``kept``."""
    rule = decision(rules, features(F.col))
    return counts.withColumns({"base_failed": base_failed(F.col), "rule": rule}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("rule") == 0)
    )


def quality_verdicts(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **learning
) -> DataFrame:
    """``(id_col, *COUNTS, base_failed, rule, kept)`` of every row of ``docs``.

    Null and empty texts have no word and fail the base rules. Repeated rows each come back,
    null ids too; other columns are dropped; an empty table gives an empty one.
    """
    counts = materialise(quality_counts(docs, id_col, text_col), "quality-counts")
    rules = learn_rules(labelled(counts, labels, id_col), **learning)
    return judge(counts, rules)


def drop_low_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **learning
) -> DataFrame:
    """``docs`` without the rows that the base rules or the learned list reject, all columns kept.

    Texts stay where they are: those with a label are counted to learn from, and every text in the scan
    that judges it. No name of a column can clash.
    """
    narrow = docs.select(docs[id_col].alias(id_col), docs[text_col].alias("text"))
    ids = known_labels(labels, id_col).select(id_col)
    counts = materialise(quality_counts(lookup_join(narrow, ids, [id_col]), id_col, "text"), "quality-counts")
    rules = learn_rules(labelled(counts, labels, id_col), **learning)
    count = lambda name: F.col("_counts")[name]
    rejected = base_failed(count) | (decision(rules, features(count)) > 0)
    row = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"))
    return with_counts(row, F.col("_row")[text_col]).where(~rejected).select("_row.*")


__all__ = ["COUNTS", "drop_low_quality", "learn_rules", "quality_verdicts"]
