"""Code-record files: JSON lines, one folder per month."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from srcsieve.constants import REPOS_PER_FILE
from srcsieve.operators.joins import global_row_number, lookup_join
from srcsieve.schema import CODE_RECORD, JSON_OPTIONS

CORRUPT = "_corrupt_record"


def read_code_records(
    spark: SparkSession,
    path: str | list[str],
    month: str | None = None,
    schema: T.StructType = CODE_RECORD,
    pattern: str = "*.json*",
    keep_corrupt: bool = False,
) -> DataFrame:
    """Scan record files below ``path``; the month comes from its ``month=`` folder.

    ``pattern`` selects file names, such as ``output*.jsonl``. Blank lines are skipped.
    Lines that are not JSON go to ``_corrupt_record`` if asked for and are dropped otherwise.
    """
    schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    rows = spark.read.schema(schema).options(**JSON_OPTIONS).option("pathGlobFilter", pattern).json(path)
    if month is not None:
        rows = rows.where(F.col("month") == month)
    if keep_corrupt:
        return rows
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def write_code_records(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = ("month",),
    rows_per_file: int = 100_000,
    replace: DataFrame | None = None,
) -> None:
    """Write records as JSON lines below one folder per month.

    The months present in ``df`` are replaced. ``replace`` lists folders, by their
    ``partition_by`` values, that are emptied first, so that a rerun which keeps no row of one
    leaves nothing old in it; ``df`` must not be read from them. The commit protocol stands in for
    writing a temporary file and renaming it. Null fields are written out. Records are
    brought together by folder first, as else every task would write a file into every
    folder; the hint lets large folders be split over tasks again.
    """
    if replace is not None:
        remove_folders(replace, path, partition_by)
    (
        df.hint("rebalance", *[F.col(c) for c in partition_by])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", False)
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*partition_by)
        .json(path)
    )


def remove_folders(folders: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
    """Delete the folders below ``path`` that ``folders`` names, one row each; absent ones do nothing."""
    spark = folders.sparkSession
    paths = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    hadoop = spark._jsc.hadoopConfiguration()
    for row in folders.select(*[F.col(c).cast("string") for c in partition_by]).distinct().toLocalIterator():
        folder = "/".join([path.rstrip("/"), *(paths.getPartitionPathString(c, row[c]) for c in partition_by)])
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(hadoop).delete(place, True)


def assign_output_batches(
    df: DataFrame,
    order: list[str],
    next_batch: int = 0,
    repos_per_file: int = REPOS_PER_FILE,
    repo: str = "repo_name",
) -> DataFrame:
    """Number the output file of each record: ``repos_per_file`` repositories share one.

    Only distinct repositories are ordered, by ``order``; ``next_batch`` is one more than
    the highest number in use, or 0.
    """
    keys = [c for c in order if c != repo]
    repos = df.groupBy(repo).agg(*[F.min(c).alias(c) for c in keys]) if keys else df.select(repo).distinct()
    numbered = global_row_number(repos, keys + [repo], "_rn").select(
        repo, (F.floor((F.col("_rn") - 1) / repos_per_file) + next_batch).cast("long").alias("batch")
    )
    return lookup_join(df, numbered, [repo])


def next_output_index(batches: DataFrame, batch: str = "batch") -> DataFrame:
    """One row: the number after the highest one in use, 0 if there is none."""
    return batches.agg(F.coalesce(F.max(batch) + 1, F.lit(0)).cast("long").alias("next_batch"))


def write_language_csv(df: DataFrame, path: str) -> None:
    """Write ``Language,Count`` with one header; a repeated run replaces the report."""
    df.select("Language", "Count").coalesce(1).write.mode("overwrite").option("header", True).csv(path)
