"""Connected components by alternating stars (Kiveris et al., SoCC 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from srcsieve.operators.joins import HOT_KEY_ROWS, attach_group
from srcsieve.session import materialise

MAX_ROUNDS = 60


def _star(directed: DataFrame, larger_only: bool, hot_key_rows: int) -> DataFrame:
    """Tie the neighbours ``v`` of each ``u`` to the smallest node around ``u``."""
    nearest = directed.groupBy("u").agg(
        F.least(F.col("u"), F.min("v")).alias("m"), F.count(F.lit(1)).alias("degree")
    )
    tied = attach_group(directed, nearest, ["u"], "degree", hot_key_rows)
    if larger_only:
        pairs = tied.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        # The row that holds the smallest neighbour stands for the node itself.
        own = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
        pairs = tied.select(own.alias("u"), F.col("m").alias("v"))
    return pairs.where(F.col("u") != F.col("v")).distinct()


def _large_star(edges: DataFrame, hot_key_rows: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _star(both, True, hot_key_rows)


def _small_star(edges: DataFrame, hot_key_rows: int) -> DataFrame:
    downward = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return _star(downward, False, hot_key_rows)


def _settled(edges: DataFrame) -> bool:
    """Whether each ``u`` hangs on one smaller ``v`` that hangs on none: no star would change a row."""
    ends = edges.select(F.col("u").alias("node"), (F.col("u") < F.col("v")).alias("rises"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(False).alias("rises"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("node").agg(F.max("rises").alias("rises"), F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.agg(F.count_if(F.col("rises") | (F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()[0] == 0


def duplicate_components(
    edges: DataFrame,
    id_col: str = "id",
    head_col: str = "head",
    max_rounds: int = MAX_ROUNDS,
    hot_key_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """``(id, root)`` for every node that is not the smallest of its component.

    Each round is written to the shared folder, so lineage stays short and a lost executor
    costs one round. Rounds grow with the logarithm of the longest chain; not settling
    within ``max_rounds`` is an error, never a partial answer.
    """
    current = materialise(
        edges.select(F.col(id_col).alias("u"), F.col(head_col).alias("v")).where(F.col("u") != F.col("v")), "edges"
    )
    for _ in range(max_rounds):
        if _settled(current):
            break
        # Each star reads its input twice, so the one between the two is written as well.
        large = materialise(_large_star(current, hot_key_rows), "large-stars")
        current = materialise(_small_star(large, hot_key_rows), "stars")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return current.select(F.col("u").alias(id_col), F.col("v").alias("root"))
