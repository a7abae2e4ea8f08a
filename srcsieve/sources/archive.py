"""Hourly event archives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from srcsieve.schema import ARCHIVE_EVENT, JSON_OPTIONS


def archive_hours(start: Column, end: Column) -> Column:
    """Every hour from ``start`` to ``end``, both included."""
    return F.explode(F.sequence(start, end, F.expr("INTERVAL 1 HOUR")))


def archive_name(hour: Column) -> Column:
    """File name of one hour; the hour of the day is not zero-padded."""
    return F.concat(F.date_format(hour, "yyyy-MM-dd-H"), F.lit(".json.gz"))


def archive_paths(bounds: DataFrame, start: str, end: str, root: str = "") -> DataFrame:
    """One path per archive hour for each ``(start, end)`` row of ``bounds``."""
    hours = bounds.select(archive_hours(F.col(start), F.col(end)).alias("hour"))
    return hours.select(F.concat(F.lit(root), archive_name(F.col("hour"))).alias("path"))


def named_events(raw: DataFrame) -> DataFrame:
    """Flat events; lines without a type or repository name are dropped.

    The JSON reader gives nulls for a broken line, so this also skips those.
    """
    return raw.select("type", F.col("repo.name").alias("repo_name"), "created_at").where(
        F.col("type").isNotNull() & F.col("repo_name").isNotNull()
    )


def existing_paths(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths, or patterns, that match something: one look-up per archive hour."""
    hadoop, found = spark._jsc.hadoopConfiguration(), []
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        if path.getFileSystem(hadoop).globStatus(path):
            found.append(name)
    return found


def read_archive_events(spark: SparkSession, paths: str | list[str] | DataFrame) -> DataFrame:
    """Read gzipped JSON lines from a folder, a list of files, or the rows of ``archive_paths``.

    Missing files are skipped, broken lines too, and a truncated file gives the lines
    before the damage.
    """
    if isinstance(paths, DataFrame):
        paths = [row["path"] for row in paths.select("path").distinct().toLocalIterator()]
    paths = existing_paths(spark, [paths] if isinstance(paths, str) else paths)
    if not paths:
        return named_events(spark.createDataFrame([], ARCHIVE_EVENT))
    raw = (
        spark.read.schema(ARCHIVE_EVENT)
        .options(**JSON_OPTIONS)
        .option("ignoreCorruptFiles", True)
        .option("ignoreMissingFiles", True)
        .json(paths)
    )
    return named_events(raw)
