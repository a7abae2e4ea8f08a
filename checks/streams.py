"""Streams: each drains landed files of all events and must equal the batch answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.quality import SQL as QUALITY_SQL
from checks.sources import INTACT, RECORD_COLUMNS, land_events
from checks.views import sql, view
from srcsieve.operators.discovery import filter_event_types
from srcsieve.operators.quality import quality_filter_chain
from srcsieve.schema import CODE_RECORD
from srcsieve.session import scratch_path
from srcsieve.streaming import archive_stream as A
from srcsieve.streaming import latest_state as L

Q: dict = {}
SQL: dict[str, str] = {}

KEPT = f"type IN ('PushEvent', 'CreateEvent') AND {INTACT}"


def _events(spark, sf):
    return A.stream_archive_events(spark, land_events(spark, sf), files_per_trigger=2)


def _drained(spark, stream, mode: str):
    path, checkpoint = scratch_path(spark, "sink"), scratch_path(spark, "offsets")
    A.write_batches(stream, path, checkpoint, mode).awaitTermination()
    return A.read_batches(spark, path, stream.schema)


Q["stream_archive_events"] = lambda spark, sf: _drained(spark, _events(spark, sf), "append").drop("batch")
SQL["stream_archive_events"] = sql(
    f"SELECT type, repo_name, created_at FROM archive_events WHERE {INTACT}", "archive_events"
)

def _latest(spark, sf):
    path, checkpoint = scratch_path(spark, "latest"), scratch_path(spark, "offsets")
    events = filter_event_types(_events(spark, sf))
    A.stream_latest_per_repo(events, path, checkpoint).awaitTermination()
    return A.merge_latest(A.read_batches(spark, path, events.select("repo_name", "created_at").schema))


Q["stream_latest_per_repo"] = _latest
SQL["stream_latest_per_repo"] = sql(
    f"SELECT repo_name, max(created_at) AS created_at FROM archive_events WHERE {KEPT} GROUP BY 1", "archive_events"
)


def _running_latest(spark, sf):
    path, checkpoint = scratch_path(spark, "running"), scratch_path(spark, "offsets")
    L.start_running_latest(filter_event_types(_events(spark, sf)), path, checkpoint).awaitTermination()
    return A.merge_latest(spark.read.schema(L.SCHEMA).parquet(path))


Q["stream_running_latest"] = _running_latest
SQL["stream_running_latest"] = SQL["stream_latest_per_repo"]


def _new_repos(spark, sf):
    path, checkpoint = scratch_path(spark, "seen"), scratch_path(spark, "offsets")
    events = filter_event_types(_events(spark, sf))
    A.stream_new_repos(events, path, checkpoint).awaitTermination()
    return A.read_batches(spark, path, events.select("repo_name").schema).select("repo_name")


Q["stream_new_repos"] = _new_repos
SQL["stream_new_repos"] = sql(f"SELECT DISTINCT repo_name FROM archive_events WHERE {KEPT}", "archive_events")

Q["stream_hourly_counts"] = lambda spark, sf: A.merge_counts(
    _drained(spark, A.stream_hourly_counts(filter_event_types(_events(spark, sf)), "60 days"), "update")
).withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH:mm:ss"))
SQL["stream_hourly_counts"] = sql(
    f"""SELECT strftime(date_trunc('hour', CAST(created_at AS TIMESTAMP)), '%Y-%m-%d %H:%M:%S') AS hour, type,
               count(*) AS events
        FROM archive_events WHERE {KEPT} GROUP BY 1, 2""",
    "archive_events",
)


def _curated(spark, sf):
    landed = scratch_path(spark, "records")
    files = view(spark, sf, "code_files").select(*CODE_RECORD.fieldNames())
    files.repartition(4).write.json(landed)  # repositories are spread over the files
    records = spark.readStream.schema(CODE_RECORD).option("maxFilesPerTrigger", 1).json(landed)
    path, checkpoint = scratch_path(spark, "curated"), scratch_path(spark, "offsets")
    A.stream_curate_to_table(records, quality_filter_chain, path, checkpoint).awaitTermination()
    schema = quality_filter_chain(files).schema
    return A.read_batches(spark, path, schema).drop("batch").withColumn("alpha", F.round("alpha", 6))


Q["stream_curate_to_table"] = _curated
SQL["stream_curate_to_table"] = QUALITY_SQL["quality_filter_chain"].replace(
    "SELECT *, CAST(len", f"SELECT {RECORD_COLUMNS}, CAST(len", 1
)
