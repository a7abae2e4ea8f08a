"""The registered queries of this subpackage and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from srcsieve.llm import (
    decontaminate, licenses, line_dedup, merkle, packing, quality_model, quality_rules, secret_scan, simhash, suffix_dedup, token_count, token_files,
    vector_codes,
)
from srcsieve.session import scratch_path, ship_package

Q: dict = {}
SQL: dict[str, str] = {}


def tokenizer(name: str) -> str:
    """Where a public tokenizer file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(function):
    Q[function.__name__] = function
    return function


@query
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


@query
def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), with_kept=False)


@query
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"),
        F.md5(F.col("text").cast("binary")).alias("kept_md5"),
    )


SQL["op5_line_dedup"] = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents),
worded AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS k
  FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
windows AS (
  SELECT doc_id, k, line AS l0, lead(line, 1) OVER w AS l1, lead(line, 2) OVER w AS l2
  FROM worded WINDOW w AS (PARTITION BY doc_id ORDER BY k)),
later AS (
  SELECT doc_id, k FROM (
    SELECT doc_id, k, row_number() OVER (PARTITION BY l0, l1, l2 ORDER BY doc_id, k) AS nth
    FROM windows WHERE l2 IS NOT NULL)
  WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, k + o AS k FROM later, (VALUES (0), (1), (2)) AS v(o)),
marked AS (
  SELECT lines.doc_id, lines.place, lines.line, worded.k IS NOT NULL AS has_word, gone.k IS NOT NULL AS removed
  FROM lines LEFT JOIN worded USING (doc_id, place) LEFT JOIN gone ON gone.doc_id = lines.doc_id AND gone.k = worded.k)
SELECT doc_id, CAST(count(*) FILTER (has_word) AS INTEGER) AS n_lines,
       CAST(count(*) FILTER (removed) AS INTEGER) AS n_removed,
       md5(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT removed), '')) AS kept_md5
FROM marked GROUP BY doc_id
"""


@query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"), scratch_path(spark, "secret-ledger"))
    of_kind = lambda *kinds: F.filter("findings", lambda f: f["kind"].isin(*kinds))
    base = [rule.kind for rule in secret_scan.BASE]
    return found.select(
        "doc_id",
        *[F.size(of_kind(kind)).cast("long").alias(f"n_{kind}") for kind in base],
        F.sha2(secret_scan.listed(of_kind(*base)).cast("binary"), 256).alias("base_sha256"),
        secret_scan.listed(F.col("findings")).alias("spans"),
    )


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality_rules.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return verdicts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_labels(table(spark, sf_dir, "documents"))


SQL["op8_license_scan"] = licenses.oracle_sql()


@query
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, codebooks = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_error(coded).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(vector_codes.codebooks_sha256(codebooks)).alias("codebooks_sha256"),
    )


SQL["op11_vector_codes"] = vector_codes.oracle_sql()


@query
def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), scratch_path(spark, "token-files")
    token_files.write_token_files(docs, folder, tokenizer("byte_bpe_50k.json"))
    return token_files.read_documents(spark, folder, id_type=docs.schema["doc_id"].dataType)


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 2 == 0
    return merkle.audit(docs, tampered, F.replace(docs["text"], F.lit("\n"), F.lit("")))


SQL["op13_merkle_manifest"] = merkle.oracle_sql()
