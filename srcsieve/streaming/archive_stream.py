"""Discovery as streams over the archive folder.

Each keyed result is a table of per-batch changes. A retried batch replaces its own
folder, so sinks are idempotent, and readers merge the changes of a key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from srcsieve.operators.key_state import KeyState
from srcsieve.schema import ARCHIVE_EVENT, JSON_OPTIONS
from srcsieve.sources.archive import named_events


def stream_archive_events(spark: SparkSession, folder: str, files_per_trigger: int = 24) -> DataFrame:
    """Pick up new hourly files; broken lines are skipped as in the batch reader."""
    raw = (
        spark.readStream.schema(ARCHIVE_EVENT)
        .options(**JSON_OPTIONS)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("ignoreCorruptFiles", True)
        .json(folder)
    )
    return named_events(raw)


def write_batches(
    stream: DataFrame, path: str, checkpoint: str, mode: str, change: Callable[[DataFrame, int], DataFrame] | None = None
) -> StreamingQuery:
    """Write each micro-batch to ``path/batch=N``, replacing what a failed try left.

    Drains what has arrived and stops (``availableNow``).
    """

    def save(batch: DataFrame, number: int) -> None:
        rows = change(batch, number) if change else batch
        rows.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        stream.writeStream.foreachBatch(save)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All changes written so far, with the number of their ``batch``."""
    schema = T.StructType([f for f in schema.fields if f.name != "batch"] + [T.StructField("batch", T.LongType())])
    return spark.read.schema(schema).option("basePath", path).option("ignoreMissingFiles", True).parquet(path)


def stream_latest_per_repo(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Latest event per repository and micro-batch, written to ``path``.

    ``merge_latest`` merges the batches, so the stream holds no state, however many repositories
    it meets.
    """
    return write_batches(events, path, checkpoint, "append", lambda batch, _: merge_latest(batch))


def merge_latest(changes: DataFrame) -> DataFrame:
    """The latest event per repository, from events or from the batches of ``stream_latest_per_repo``."""
    return changes.groupBy("repo_name").agg(F.max("created_at").alias("created_at"))


def stream_new_repos(events: DataFrame, path: str, checkpoint: str, **state: int) -> StreamingQuery:
    """Emit each repository once, for as long as the state below ``path`` is kept.

    The names seen lie in hash buckets in ``_seen`` below ``path``, where table reads do not look, and a
    micro-batch opens only the buckets that its names may be in (``KeyState``, shaped by ``state``). A retried
    batch ignores what it wrote before.
    """
    seen = KeyState(events.sparkSession, f"{path}/_seen", **state)

    def unseen(batch: DataFrame, number: int) -> DataFrame:
        return seen.unseen(batch.select("repo_name").distinct(), ["repo_name"], number)

    return write_batches(events, path, checkpoint, "append", unseen)


def stream_distinct_repos(events: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Repositories not seen within ``delay``: bounded state, repeats after a pause."""
    timed = events.withColumn("ts", F.to_timestamp("created_at"))
    return timed.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["repo_name"]).select("repo_name")


def stream_hourly_counts(events: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Events per archive hour and type; rows later than ``delay`` are dropped.

    Mode ``append`` emits an hour once it is closed, ``update`` emits running counts.
    """
    timed = events.withColumn("ts", F.to_timestamp("created_at"))
    counted = timed.withWatermark("ts", delay).groupBy(F.window("ts", "1 hour"), "type").agg(
        F.count(F.lit(1)).alias("events")
    )
    return counted.select(F.col("window.start").alias("hour"), "type", "events")


def merge_counts(changes: DataFrame) -> DataFrame:
    """The current counts from the ``update`` changes of ``stream_hourly_counts``."""
    return changes.groupBy("hour", "type").agg(F.max_by("events", "batch").alias("events"))


def stream_curate_to_table(
    records: DataFrame, curate: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, **state: int
) -> StreamingQuery:
    """Curate arriving records; a file that an earlier micro-batch brought is not added again.

    A file is known by its repository, name and text, so a repository may be spread over any number of
    micro-batches. Digests of all that arrived, kept or not, lie in hash buckets in ``_seen`` below ``path``
    (``KeyState``, shaped by ``state``), where table reads do not look.
    """
    seen = KeyState(records.sparkSession, f"{path}/_seen", **state)

    def fresh(batch: DataFrame, number: int) -> DataFrame:
        named = batch.withColumn("_text", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
        return curate(seen.unseen(named, ["repo_name", "file_name", "_text"], number).drop("_text"))

    return write_batches(records, path, checkpoint, "append", fresh)
