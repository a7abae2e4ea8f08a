"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from srcsieve.session import materialise

#: Largest dimension or work list sent to every executor.
MAX_BROADCAST_ROWS = 100_000
#: Largest lookup table sent to every executor, by its measured bytes; beyond it rows meet in a
#: shuffle. ``spark.srcsieve.maxBroadcastBytes`` sets it for a session with larger machines.
MAX_BROADCAST_BYTES = 256 << 20
#: A key with this many rows is hot. At most ``rows / HOT_KEY_ROWS`` keys can be hot, so a
#: list of hot keys stays small enough to broadcast at any corpus size.
HOT_KEY_ROWS = 1_000_000


def once(*scores: Column) -> Column:
    """Columns computed once per row, however often later filters refer to them.

    A filter over a plain projection is pushed below it, which evaluates the expression in
    the filter and again in the projection. A generator is a barrier to that, and still
    runs inside whole-stage code generation.
    """
    return F.inline(F.array(F.struct(*scores)))


def table_bytes(table: DataFrame) -> int:
    """About what the rows of ``table`` take in a hash table: measured texts, fixed widths, an entry per row."""
    width = F.lit(32)
    for field in table.schema:
        fixed = isinstance(field.dataType, (T.NumericType, T.BooleanType, T.DatetimeType))
        size = F.lit(8) if fixed else F.coalesce(F.octet_length(F.col(field.name).cast("string")), F.lit(0)) + 16
        width = width + size
    return table.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()[0]


def broadcast_limit(spark: SparkSession) -> int:
    """Bytes of the largest table that is sent to every executor."""
    return int(spark.conf.get("spark.srcsieve.maxBroadcastBytes", str(MAX_BROADCAST_BYTES)))


def fits_broadcast(table: DataFrame, max_bytes: int | None = None) -> bool:
    """Whether the bytes of ``table`` allow a broadcast; one narrow job measures them."""
    return table_bytes(table) <= (broadcast_limit(table.sparkSession) if max_bytes is None else max_bytes)


def small_table(table: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``table``, written once and marked for broadcast if its bytes allow it."""
    table = materialise(table, "lookup")
    return F.broadcast(table) if fits_broadcast(table, max_bytes) else table


def dimension(table: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """A table drawn from the language dictionary: local rows, broadcast, if there are at most ``max_rows``.

    One small job checks the size and fetches the rows at once; a larger table stays as it is.
    """
    rows = table.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return table
    return F.broadcast(table.sparkSession.createDataFrame(rows, table.schema))


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    on: list[str],
    how: str = "inner",
    max_broadcast_bytes: int | None = None,
    hot_key_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Join wide ``rows`` with ``table``, which has one row per ``on`` key.

    A small table is broadcast, so the wide rows do not move. Otherwise the rows are
    shuffled, except those of hot keys: their few table rows are broadcast instead. Rows
    with a null key match nothing and stay where they are.
    """
    table = materialise(table, "lookup")
    if fits_broadcast(table, max_broadcast_bytes):
        return rows.join(F.broadcast(table), on, how)
    keyed = rows.dropna(subset=on)
    hot = materialise(
        keyed.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= hot_key_rows).drop("_n"),
        "hot-keys",
    )
    if hot.isEmpty():
        joined = keyed.join(table, on, how)
    else:
        hot_table = table.join(F.broadcast(hot), on, "left_semi")
        joined = keyed.join(F.broadcast(hot), on, "left_anti").join(table, on, how).unionByName(
            keyed.join(F.broadcast(hot), on, "left_semi").join(F.broadcast(hot_table), on, how)
        )
    if how in ("left", "left_anti"):
        null_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
        joined = joined.unionByName(rows.where(null_key), allowMissingColumns=True)
    return joined


def attach_group(
    members: DataFrame, groups: DataFrame, on: list[str], size: str, hot_key_rows: int = HOT_KEY_ROWS
) -> DataFrame:
    """Inner join of narrow ``members`` with their ``groups``, whose row count is ``size``.

    Members of a large group are matched where they are, against a broadcast of the few
    large groups; all others meet in a shuffle where no key has ``hot_key_rows`` rows.
    """
    groups = materialise(groups, "groups")  # aggregated once, though used up to three times
    hot = groups.where(F.col(size) >= hot_key_rows)
    if hot.isEmpty():
        return members.join(groups, on)
    cold = groups.where(F.col(size) < hot_key_rows)
    in_place = members.join(F.broadcast(hot), on)
    shuffled = members.join(F.broadcast(hot.select(*on)), on, "left_anti").join(cold, on)
    return shuffled.unionByName(in_place)


def drop_ids(rows: DataFrame, removed: DataFrame, id_col: str, max_broadcast_bytes: int | None = None) -> DataFrame:
    """``rows`` without the ids in ``removed``. Ids are unique, so no key is hot.

    Ids are compared by a 128-bit digest, which takes a fifth of a long id's bytes: four million
    fit the default broadcast, and the rows stay in place. Null ids stay.
    """
    listed = small_table(removed.select(_id_digest(removed[id_col]).alias("_gone")), max_broadcast_bytes)
    return rows.join(listed, _id_digest(rows[id_col]) == listed["_gone"], "left_anti")


def _id_digest(id_column: Column) -> Column:
    return F.unhex(F.md5(id_column.cast("string").cast("binary")))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give every core work before costly per-row Python, when the input has few splits.

    Only an input that is small for the cluster is shuffled (below one full split per
    core); a larger one already has enough splits and is left where it is.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    full_split = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(split))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores * 2, key) if size < cores * full_split else df


def global_row_number(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Number rows from 1 in ``order`` without sorting them all in one task.

    Rows are split into ranges, ranges are numbered apart and shifted by the rows before
    them. Ranges are written first, so a retried task cannot move their bounds.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialise(
        df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    within = Window.partitionBy("_range").orderBy(*order)
    return (
        ranged.join(F.broadcast(offsets), "_range")
        .withColumn(name, F.col("_offset") + F.row_number().over(within))
        .drop("_range", "_offset")
    )
