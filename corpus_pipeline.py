"""From documents to packed sequences: the stages of a training corpus.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and returns the rows
that the next stage reads. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from srcsieve.llm import decontaminate, line_dedup, packing, quality_rules, simhash
from srcsieve.llm.queries import table, tokenizer
from srcsieve.session import materialise

#: Rows of an Arrow batch, as in ``build_session``: a batch of whole texts is held by the executor and twice by its worker.
BATCH_ROWS = "1000"


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned decision list reject."""
    return quality_rules.drop_low_quality(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated passages of three lines; those that lose every word go."""
    return line_dedup.drop_repeated_lines(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    small_batches(spark)
    return simhash.drop_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    small_batches(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of at most 2,048 tokens."""
    small_batches(spark)
    return packing.pack_documents(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", keep_quality),
    ("line dedup", dedup_lines),
    ("simhash near-dedup", dedup_documents),
    ("benchmark decontamination", drop_leaks),
    ("best-fit packing", pack),
]

#: The learned rules, fingerprints and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in order over ``documents``, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = materialise(docs, f"stage-{number}")
    return docs
