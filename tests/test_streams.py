import json

from pyspark.sql import functions as F

from srcsieve.operators.quality import quality_filter_chain
from srcsieve.schema import CODE_RECORD
from srcsieve.streaming import archive_stream as A


def land(folder, name, events):
    lines = [json.dumps({"type": t, "repo": {"name": r}, "created_at": at}) for r, t, at in events]
    (folder / name).write_text("\n".join(lines))


def events(spark, folder):
    return A.stream_archive_events(spark, str(folder), files_per_trigger=1)


def test_new_repos_across_runs(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    sink, offsets = str(tmp_path / "seen"), str(tmp_path / "offsets")
    land(folder, "a.json", [("o/a", "PushEvent", "2025-01-01T00:00:00Z"), ("o/b", "PushEvent", "2025-01-01T00:10:00Z")])
    A.stream_new_repos(events(spark, folder), sink, offsets).awaitTermination()
    land(folder, "b.json", [("o/b", "PushEvent", "2025-06-01T00:00:00Z"), ("o/c", "PushEvent", "2025-06-01T00:10:00Z")])
    A.stream_new_repos(events(spark, folder), sink, offsets).awaitTermination()
    key = events(spark, folder).select("repo_name").schema
    got = A.read_batches(spark, sink, key).collect()
    assert sorted(r.repo_name for r in got) == ["o/a", "o/b", "o/c"]


def test_a_retried_batch_replaces_itself(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    sink = str(tmp_path / "sink")
    land(folder, "a.json", [("o/a", "PushEvent", "2025-01-01T00:00:00Z")])
    stream = events(spark, folder)
    for run in range(2):  # a lost checkpoint makes the same batch run again
        A.write_batches(stream, sink, str(tmp_path / f"offsets{run}"), "append").awaitTermination()
    assert A.read_batches(spark, sink, stream.schema).count() == 1


def test_late_events_are_dropped(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    sink, offsets = str(tmp_path / "sink"), str(tmp_path / "offsets")
    hours = [
        ("a.json", [("o/a", "PushEvent", "2025-01-01T05:30:00Z")]),
        ("b.json", [("o/b", "PushEvent", "2025-01-01T03:10:00Z"), ("o/b", "PushEvent", "2025-01-01T05:10:00Z")]),
        ("c.json", [("o/c", "PushEvent", "2025-01-01T09:00:00Z")]),
    ]
    for name, rows in hours:  # one run per file fixes their order
        land(folder, name, rows)
        stream = A.stream_hourly_counts(events(spark, folder), "1 hour")
        A.write_batches(stream, sink, offsets, "append").awaitTermination()
    got = A.read_batches(spark, sink, stream.schema)
    closed = {(str(r.hour), r.events) for r in got.select(F.date_format("hour", "HH").alias("hour"), "events").collect()}
    assert closed == {("05", 2)}


def test_distinct_within_watermark(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    sink = str(tmp_path / "sink")
    land(folder, "a.json", [("o/a", "PushEvent", f"2025-01-01T00:{m:02d}:00Z") for m in range(5)])
    stream = A.stream_distinct_repos(events(spark, folder))
    A.write_batches(stream, sink, str(tmp_path / "offsets"), "append").awaitTermination()
    assert A.read_batches(spark, sink, stream.schema).count() == 1


def test_curated_repositories_are_not_added_twice(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    sink, offsets = str(tmp_path / "sink"), str(tmp_path / "offsets")
    text = "\n".join(["several plain words on this line"] * 6)

    def run(name, repos):
        lines = [json.dumps({"repo_name": r, "language": "R", "file_name": f"{i}.R", "text": text}) for r in repos for i in (1, 2)]
        (folder / name).write_text("\n".join(lines))
        records = spark.readStream.schema(CODE_RECORD).option("maxFilesPerTrigger", 1).json(str(folder))
        A.stream_curate_to_table(records, quality_filter_chain, sink, offsets).awaitTermination()

    run("a.json", ["o/a"])
    run("b.json", ["o/a", "o/b"])
    schema = quality_filter_chain(spark.createDataFrame([], CODE_RECORD)).schema
    got = A.read_batches(spark, sink, schema).groupBy("repo_name").count().collect()
    assert {r.repo_name: r["count"] for r in got} == {"o/a": 2, "o/b": 2}


def test_a_repository_over_several_micro_batches_is_kept_whole(spark, tmp_path):
    folder = tmp_path / "records"
    folder.mkdir()
    names = CODE_RECORD.fieldNames()

    def land_records(part, first):
        rows = [dict.fromkeys(names) | {"repo_name": "a/a", "file_name": f"f{i}.py", "text": f"text {i}"} for i in range(first, first + 25)]
        (folder / f"{part}.json").write_text("\n".join(map(json.dumps, rows)))

    def run():
        records = spark.readStream.schema(CODE_RECORD).option("maxFilesPerTrigger", 1).json(str(folder))
        A.stream_curate_to_table(records, lambda df: df, str(tmp_path / "out"), str(tmp_path / "at")).awaitTermination()
        return A.read_batches(spark, str(tmp_path / "out"), CODE_RECORD).count()

    for part in range(4):
        land_records(part, 25 * part)
    assert run() == 100
    land_records(4, 75)  # the last file once more
    land_records(5, 100)
    assert run() == 125


def test_latest_per_repo_across_runs(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    sink, offsets = str(tmp_path / "latest"), str(tmp_path / "offsets")
    hours = [("a.json", ["05", "03"]), ("b.json", ["04"]), ("c.json", ["09"])]
    for name, at in hours:
        land(folder, name, [("o/a", "PushEvent", f"2025-01-01T{h}:00:00Z") for h in at])
        A.stream_latest_per_repo(events(spark, folder), sink, offsets).awaitTermination()
    written = A.read_batches(spark, sink, events(spark, folder).select("repo_name", "created_at").schema)
    assert [r.created_at[11:13] for r in A.merge_latest(written).collect()] == ["09"]
    assert written.count() == 3
