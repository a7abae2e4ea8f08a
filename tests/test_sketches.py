"""Mergeable summaries against exact counts."""

import os

from pyspark.sql import functions as F

from srcsieve.operators import sketches as S
from srcsieve.operators.reports import dataset_summary


def corpus(spark, rows=60_000):
    """Twelve months; texts of 0 to 499 words, a language that holds a third of the files, many rare ones."""
    return spark.range(rows).select(
        (F.col("id") % 12 + 1).cast("string").alias("month"),
        F.concat(F.lit("o/r"), (F.pmod(F.xxhash64("id"), F.lit(20_000))).cast("string")).alias("repo_name"),
        F.when(F.col("id") % 3 == 0, "Python").otherwise(F.concat(F.lit("L"), F.sqrt(F.col("id") % 400).cast("int").cast("string"))).alias("language"),
        F.repeat(F.lit("w "), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(500)).cast("int")).alias("text"),
    )


def test_twelve_merged_months_are_within_the_stated_error(spark, tmp_path):
    df, path = corpus(spark), str(tmp_path / "sketches")
    for half in (F.col("month").cast("int") <= 6, F.col("month").cast("int") > 6):  # two runs
        S.save_sketches(df.where(half), path)
    got = S.summary_from_sketches(spark, path, quantiles=(0.1, 0.5, 0.9)).first()
    exact = dataset_summary(df).first()
    assert (got.files, got.bytes, got.tokens) == (exact.files, exact.bytes, exact.tokens)
    assert abs(got.repos - exact.repos) <= 3 * 0.0082 * exact.repos
    for q, value in zip((0.1, 0.5, 0.9), got.token_quantiles):
        below = df.where(F.size(F.split("text", " ")) - 1 <= value).count() / exact.files
        assert abs(below - q) <= 0.01
    counts = {r.language: r["count"] for r in df.groupBy("language").count().collect()}
    assert len(got.top_languages) == 10 and got.top_languages[0].item == "Python"
    assert all(counts[r.item] == r["count"] for r in got.top_languages)
    assert [r["count"] for r in got.top_languages] == sorted(counts.values(), reverse=True)[:10]


def test_merging_in_steps_gives_the_same(spark):
    months = S.sketch_records(corpus(spark, 6000))
    once = S.read_out(S.merge_sketches(months)).first()
    halves = S.merge_sketches(months.withColumn("half", F.col("month") > "3"), ("half",))
    twice = S.read_out(S.merge_sketches(halves.drop("half"))).first()
    assert once[1:4] == twice[1:4]
    assert abs(once.repos - twice.repos) <= 0.01 * once.repos
    assert {tuple(r) for r in once.top_languages} >= {tuple(r) for r in twice.top_languages[:5]}


def test_a_month_done_again_replaces_itself_and_no_text_is_read_to_merge(spark, tmp_path):
    df, path = corpus(spark, 2400), str(tmp_path / "sketches")
    S.save_sketches(df, path)
    files = {name: os.listdir(f"{path}/{name}") for name in os.listdir(path) if name.startswith("month=")}
    S.save_sketches(df.where("month = '4'").limit(10), path)
    after = {name: os.listdir(f"{path}/{name}") for name in files}
    assert [name for name in files if files[name] != after[name]] == ["month=4"]
    state = S.read_sketches(spark, path)
    assert S.read_out(S.merge_sketches(state)).first().files == 2400 - 200 + 10
    assert "text" not in state.columns and all("sketches" in f for f in state.inputFiles())


def test_nulls_empty_texts_and_empty_tables(spark):
    schema = "month string, repo_name string, language string, text string"
    rows = [("1", "a", "R", "x y"), ("1", None, None, None), ("2", "a", None, ""), (None, "b", "R", "z")]
    months = S.sketch_records(spark.createDataFrame(rows, schema))
    assert months.count() == 3
    got = S.read_out(S.merge_sketches(months), quantiles=(0.5, 1.0)).first()
    assert got[:4] == (2, 4, 4, 3) and got.token_quantiles == [1, 2]
    assert {(r.item, r["count"]) for r in got.top_languages} == {("R", 2), (None, 2)}
    empty = S.read_out(S.merge_sketches(S.sketch_records(spark.createDataFrame([], schema)))).first()
    assert empty[:5] == (0, 0, 0, 0, None)


def test_a_column_of_another_name(spark, tmp_path):
    path = str(tmp_path / "sketches")
    S.save_sketches(corpus(spark, 1200).withColumn("month", F.col("month").cast("int")).withColumnRenamed("month", "month_no"), path, "month_no")
    by_month = S.read_out(S.read_sketches(spark, path, "int"), ("month",)).orderBy("month").collect()
    assert [r.month for r in by_month] == list(range(1, 13)) and {r.files for r in by_month} == {100}
