"""Whole jobs from landed folders to written ones."""

import json

from pyspark.sql import functions as F

from srcsieve.plans import jobs
from srcsieve.sources.records import read_code_records, write_code_records

SCHEMA = (
    "repo_name string, description string, stars long, file_count long, size_kb long, language string, "
    "license string, file_name string, text string, month string"
)


def land(spark, path):
    notebook = json.dumps({"cells": [{"cell_type": "code", "source": "x = 1"}], "metadata": {"language_info": {"name": "julia"}}})
    rows = [
        ("a/a", None, 1, 1, 1, "Jupyter Notebook", "mit", "n.ipynb", notebook, "1"),
        ("a/a", None, 1, 1, 1, "Wrong", "mit", "f.py", "print()", "1"),
        ("b/b", None, 1, 1, 1, "Jupyter Notebook", "mit", "bad.ipynb", "{broken", "2"),
    ]
    write_code_records(spark.createDataFrame(rows, SCHEMA), path)


def dim(spark):
    return spark.createDataFrame([(".py", "Python")], "extension string, language string")


def test_notebook_job(spark, tmp_path):
    source, target = str(tmp_path / "raw"), str(tmp_path / "done")
    land(spark, source)
    for _ in range(2):  # a rerun replaces what it wrote
        issues = jobs.notebook_job(spark, source, target)
        got = {(r.file_name, r.language, r.text, r.month) for r in read_code_records(spark, target).collect()}
        assert got == {("n.ipynb", "Julia", "x = 1", 1), ("f.py", "Wrong", "print()", 1)}
    assert [(r.month, r.file_name) for r in issues.collect()] == [("2", "bad.ipynb")]


def test_relabel_and_report_jobs(spark, tmp_path):
    source, target, report = (str(tmp_path / n) for n in ("raw", "relabelled", "report"))
    land(spark, source)
    jobs.relabel_job(spark, source, target, dim(spark))
    got = {r.file_name: r.language for r in read_code_records(spark, target).collect()}
    assert got == {"f.py": "Python", "n.ipynb": "Unknown", "bad.ipynb": "Unknown"}
    jobs.language_report_job(spark, source, report, dim(spark))
    rows = spark.read.option("header", True).csv(report).collect()
    assert {r.Language: int(r.Count) for r in rows} == {"Python": 1, "Unknown": 2}


def test_discovery_stops_at_max_repos(spark):
    events = spark.createDataFrame(
        [("PushEvent", f"o/{i}", f"2025-01-01T00:00:0{9 - i}Z") for i in range(5)], "type string, repo_name string, created_at string"
    )
    meta = spark.sql(
        "SELECT CAST(NULL AS STRING) full_name, 1L stargazers_count, 1L size, '' language, '' description, '' default_branch, "
        "named_struct('key', '') license WHERE false"
    )
    seen = spark.createDataFrame([], "month_no int, repo_name string")
    languages = spark.createDataFrame([("Python",)], "language string")
    judged = jobs.discover_repos(events, meta, seen, languages, 1, max_repos=2)
    assert sorted(r.repo_name for r in judged.select("repo_name").collect()) == ["o/3", "o/4"]
    assert judged.where(F.col("reason") != "no metadata").count() == 0


def test_null_texts_are_no_copies(spark):
    from srcsieve.operators.exact_dedup import exact_dedup

    rows = spark.createDataFrame([("1", None), ("2", None), ("3", "x"), ("4", "x")], "my_id string, text string")
    assert sorted(r.my_id for r in exact_dedup(rows).collect()) == ["1", "2", "3"]


def test_only_folders_of_the_work_are_read(spark, tmp_path):
    path = str(tmp_path / "records")
    rows = spark.range(60).select(F.col("id").cast("string").alias("text"), (F.col("id") % 6).alias("month"), F.lit(0).alias("batch"))
    rows.write.partitionBy("month", "batch").json(path)
    work = str(tmp_path / "work")
    spark.createDataFrame([(1, 0, "dedup"), (4, 0, "filter")], "month long, batch int, start_at string").write.parquet(work)
    stored = spark.read.schema("text string, month long, batch int").json(path)
    for stages, months in ((("dedup",), {1}), (("dedup", "filter"), {1, 4})):
        got = jobs.rows_of_batches(stored, spark.read.parquet(work), ["month", "batch"], stages)
        assert {r.month for r in got.collect()} == months and got.count() == 10 * len(months)
        assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()


def test_unreadable_files_are_logged(spark, tmp_path, monkeypatch):
    from srcsieve.sources import tree

    repo = tmp_path / "o__a"
    repo.mkdir()
    (repo / "good.py").write_text("x = 1")
    listed = spark.createDataFrame([("o/a", "good.py"), ("o/a", "gone.py")], "repo_name string, file_name string")
    assert [r.file_name for r in tree.read_file_contents(listed, str(tmp_path)).collect()] == ["good.py"]
    read = tree.read_file_contents(listed, str(tmp_path), error="why")
    got = {r.file_name: (r.text, r.why) for r in tree.decode_text(read).collect()}
    assert got["good.py"] == ("x = 1", None)
    assert got["gone.py"][0] is None and "FileNotFoundError" in got["gone.py"][1]


def test_a_store_that_fails_for_a_moment_is_asked_again(tmp_path, monkeypatch):
    from srcsieve.sources import tree

    class Flaky:
        def __init__(self, failures):
            self.left = failures

        def open_input_stream(self, path, compression=None):
            if self.left:
                self.left -= 1
                raise OSError("time-out")
            return open(path, "rb")

    monkeypatch.setattr(tree.time, "sleep", lambda _: None)
    (tmp_path / "f").write_bytes(b"x")
    assert tree._read_bytes(Flaky(2), str(tmp_path / "f")) == (b"x", None)
    assert tree._read_bytes(Flaky(3), str(tmp_path / "f")) == (None, "OSError: time-out")


def test_records_are_collected_and_failures_logged(spark, tmp_path, monkeypatch):
    repo = tmp_path / "tree" / "o__a"
    repo.mkdir(parents=True)
    (repo / "good.py").write_text("x = 1")
    (repo / "link.py").write_text("y")
    listing = jobs.list_source_files

    def and_a_lost_file(repos, root):
        extra = spark.createDataFrame([("o/a", "lost.py", 3)], "repo_name string, file_name string, length long")
        return listing(repos, root).unionByName(extra)

    monkeypatch.setattr(jobs, "list_source_files", and_a_lost_file)
    meta = spark.createDataFrame(
        [("o/a", None, 60, "main", "mit", 70_000, "Python")],
        "repo_name string, description string, stars long, default_branch string, license string, size long, language string",
    )
    extensions = spark.createDataFrame([(".py",)], "extension string")
    log = str(tmp_path / "log")
    got = jobs.collect_records(meta, str(tmp_path / "tree"), dim(spark), extensions, unreadable=log).collect()
    assert sorted((r.file_name, r.text, r.file_count) for r in got) == [("good.py", "x = 1", 3), ("link.py", "y", 3)]
    assert [r.file_name for r in spark.read.parquet(log).collect()] == ["lost.py"]
