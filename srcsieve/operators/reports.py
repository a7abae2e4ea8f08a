"""Corpus reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from srcsieve.functions.text import token_count


def dataset_summary(df: DataFrame) -> DataFrame:
    """One row: repositories, files, bytes of text and default tokens.

    Counting per repository first keeps the distinct count a plain sum over partial rows.
    """
    per_repo = df.groupBy("repo_name").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum(F.octet_length("text")).alias("bytes"),
        F.sum(token_count("text")).alias("tokens"),
    )
    total = lambda name: F.coalesce(F.sum(name), F.lit(0)).cast("long").alias(name)
    return per_repo.agg(F.count("repo_name").alias("repos"), total("files"), total("bytes"), total("tokens"))
