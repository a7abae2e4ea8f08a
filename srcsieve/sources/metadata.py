"""Landed repository responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from srcsieve.schema import JSON_OPTIONS, REPO_RESPONSE


def read_repo_metadata(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per landed response, with the seven fields the pipeline uses."""
    return spark.read.schema(REPO_RESPONSE).options(**JSON_OPTIONS).json(path).dropna(subset=["full_name"])
