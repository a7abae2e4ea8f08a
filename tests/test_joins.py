import pytest
from pyspark.sql import functions as F

from srcsieve.operators.joins import attach_group, drop_ids, fits_broadcast, global_row_number, lookup_join, once, table_bytes


def rows_of(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("limits", [(10_000, 5), (0, 5), (0, 1000)])
def test_lookup_join(spark, how, limits):
    keys = ["hot"] * 40 + ["b", "c", "c", None, None, "missing"] + ["hot2"] * 9
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k string")
    table = spark.createDataFrame([("hot", 1), ("b", 2), ("c", 3), ("unused", 4)], "k string, v int")
    got = lookup_join(rows, table, ["k"], how, max_broadcast_bytes=limits[0], hot_key_rows=limits[1])
    want = rows.join(table, ["k"], how)
    assert rows_of(got.select(*want.columns)) == rows_of(want)


def test_attach_group_with_hot_groups(spark):
    members = spark.createDataFrame([(i, "h" if i < 30 else f"k{i % 4}") for i in range(50)], "i int, k string")
    groups = members.groupBy("k").agg(F.min("i").alias("head"), F.count("*").alias("n")).where("n > 1")
    got = attach_group(members, groups, ["k"], "n", hot_key_rows=10)
    assert rows_of(got.select("i", "head")) == rows_of(members.join(groups, "k").select("i", "head"))


def test_global_row_number(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"))
    got = global_row_number(df, ["x"], "rn").collect()
    assert sorted((r.x, r.rn) for r in got) == [(i, i + 1) for i in range(1000)]


def test_once_is_not_pushed_into_the_filter(spark):
    df = spark.createDataFrame([("a b",)], "t string").select("t", once(F.regexp_replace("t", "a", "x").alias("s")))
    plan = df.where("s <> ''")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace") == 1


def test_broadcasts_are_measured_in_bytes(spark):
    narrow = spark.range(1000).select(F.col("id").cast("string").alias("k"), "id")
    wide = narrow.withColumn("t", F.repeat(F.lit("é"), 5000)).limit(100)
    assert 50_000 < table_bytes(narrow) < 100_000 and table_bytes(wide) > 1_000_000
    assert fits_broadcast(narrow, 100_000) and not fits_broadcast(wide, 100_000)
    assert table_bytes(wide.limit(0)) == 0


@pytest.mark.parametrize("limit", [None, 0])
def test_drop_ids(spark, limit):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("", 4), ("a", 5)], "my_id string, n int")
    gone = spark.createDataFrame([("a",), ("x",), ("",), (None,)], "my_id string")
    got = drop_ids(rows, gone, "my_id", limit)
    assert got.columns == ["my_id", "n"] and sorted(r.n for r in got.collect()) == [2, 3]


def test_a_large_lookup_leaves_texts_in_place(spark):
    texts = spark.range(10).select(F.col("id").cast("string").alias("repo_name"), F.lit("x").alias("text"))
    names = spark.range(300_000).select(F.col("id").cast("string").alias("repo_name"), "id")
    plan = lookup_join(texts, names, ["repo_name"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
