"""Near duplicates of a corpus that grows: a kept index instead of a new pass over all texts.

An index folder holds two tables, written run by run under ``run=N``:

- ``heads``: the smallest id of every band bucket, written again only where it is new or fell;
- ``labels``: every id with the smallest id of its group, written again only where that changed.

Both only ever fall, so the current value of a key is the minimum over all runs, in whatever order they
are read, and a run that is done again replaces its own folder. A new run signs its own records only. Its
buckets meet the kept heads; the edges found join new ids with whole groups, known by their label, so
components are settled over new ids and touched groups, and only members of these are labelled anew.

Equal texts share every bucket, so exact copies fall into one group with near ones, and what is kept after
any number of runs are the rows that ``deduplicate`` keeps of all their records at once.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from srcsieve.operators.components import duplicate_components
from srcsieve.operators.exact_dedup import ID_KEYS, Removal, add_doc_id
from srcsieve.operators.joins import HOT_KEY_ROWS, lookup_join
from srcsieve.operators.minhash import band_keys, bucket_heads, lsh_candidate_edges, minhash_signatures
from srcsieve.session import materialise, path_exists, read_runs

HEADS = "band int, bucket binary, head string"
LABELS = "id string, root string"


class IndexUpdate(NamedTuple):
    """``kept``: the run's records that stay. ``retracted``: ids kept by earlier runs that now go (``id_col``)."""

    kept: DataFrame
    retracted: DataFrame


def _write(rows: DataFrame, index: str, name: str, run: int) -> None:
    rows.write.mode("overwrite").parquet(f"{index}/{name}/run={run}")


def _smallest(log: DataFrame, keys: list[str], value: str) -> DataFrame:
    return log.groupBy(*keys).agg(F.min(value).alias(value))


def _named(edges: DataFrame, known: DataFrame, hot_key_rows: int) -> DataFrame:
    """``edges (a, b)`` with every known id replaced by the label of its group."""
    for end in ("a", "b"):
        labels = known.select(F.col("id").alias(end), F.col("root").alias("_root"))
        edges = lookup_join(edges, labels, [end], "left", hot_key_rows=hot_key_rows)
        edges = edges.withColumn(end, F.coalesce("_root", end)).drop("_root")
    return edges.select("a", "b").where(F.col("a") != F.col("b")).distinct()


def add_to_index(
    records: DataFrame,
    index: str,
    run: int,
    id_col: str = "my_id",
    text: str = "text",
    keys: tuple[str, ...] = ID_KEYS,
    hot_key_rows: int = HOT_KEY_ROWS,
    **params: int,
) -> IndexUpdate:
    """Add the ``records`` of a run to the index and say what stays.

    Runs are numbered in order, and only the last one may be done again; it then gives the same rows and replaces what
    a failed try left. Texts of earlier runs are not read: their signatures are in the index.
    ``params`` shape the signatures and must be the same for all runs.

    A null text counts as an empty one. Records that an earlier run brought already are dropped, of equal records
    in the run one is kept, and an empty run changes nothing.
    """
    spark = records.sparkSession
    heads_log, labels_log = (
        read_runs(spark, f"{index}/heads", HEADS, run), read_runs(spark, f"{index}/labels", LABELS, run)
    )
    if path_exists(spark, f"{index}/labels/run={run + 1}"):
        raise ValueError(f"run {run} is not the last one of {index}")
    identified = add_doc_id(records, id_col, keys)
    shape = {k: v for k, v in params.items() if k in ("bands", "rows")}
    signed = minhash_signatures(identified, id_col, text, **params)
    prints = materialise(
        signed.select(F.col(id_col).alias("id"), F.posexplode(band_keys(**shape)).alias("band", "bucket")), "prints"
    )

    # Buckets of this run against those of earlier ones, one row per bucket on either side.
    counted = materialise(bucket_heads(prints, "id"), "heads")
    heads = counted.drop("members")
    old = heads_log.join(heads.select("band", "bucket"), ["band", "bucket"], "left_semi")
    old = _smallest(old, ["band", "bucket"], "head").withColumnRenamed("head", "old")
    met = materialise(heads.join(old, ["band", "bucket"], "left"), "met")
    _write(met.where("old IS NULL OR head < old").select("band", "bucket", "head"), index, "heads", run)

    within = lsh_candidate_edges(prints, "id", counted).select(F.col("id").alias("a"), F.col("head").alias("b"))
    across = met.where("old IS NOT NULL AND head <> old").select(F.col("head").alias("a"), F.col("old").alias("b"))
    edges = materialise(within.unionByName(across).distinct(), "edges")

    # The groups that these ids belong to.
    ids = materialise(prints.where("band = 0").groupBy("id").agg(F.count(F.lit(1)).alias("n")), "ids")
    asked = ids.select("id").unionByName(edges.select(F.col("b").alias("id"))).distinct()
    known = materialise(_smallest(labels_log.join(asked, "id", "left_semi"), ["id"], "root"), "known")
    groups = materialise(duplicate_components(_named(edges, known, hot_key_rows), "a", "b", hot_key_rows=hot_key_rows), "groups")

    mine = ids.join(known, "id", "left").select(
        "id", "n", F.coalesce("root", "id").alias("a"), F.col("root").isNotNull().alias("again")
    )
    roots = groups.select("a", F.col("root").alias("_root"))
    mine = lookup_join(mine, roots, ["a"], "left", hot_key_rows=hot_key_rows)
    mine = materialise(mine.select("id", "n", "again", F.coalesce("_root", "a").alias("root")), "new-labels")
    fell = materialise(groups.join(known.select(F.col("root").alias("a")).distinct(), "a", "left_semi"), "fell")
    moved = lookup_join(
        labels_log, fell.select(F.col("a").alias("root"), F.col("root").alias("_root")), ["root"],
        hot_key_rows=hot_key_rows,
    ).select("id", F.col("_root").alias("root"))
    _write(mine.select("id", "root").unionByName(moved).distinct(), index, "labels", run)

    stays = (F.col("id") == F.col("root")) & ~F.col("again")
    removed = mine.where(~stays).select(F.col("id").alias(id_col))
    twins = mine.where(stays & (F.col("n") > 1)).select(F.col("id").alias(id_col))
    return IndexUpdate(Removal(removed, twins).apply(identified, id_col, ()), fell.select(F.col("a").alias(id_col)))


def index_labels(spark: SparkSession, index: str) -> DataFrame:
    """``(id, root)`` of every record ever added: the smallest id of its group."""
    return _smallest(read_runs(spark, f"{index}/labels", LABELS), ["id"], "root")


def kept_ids(spark: SparkSession, index: str, id_col: str = "my_id") -> DataFrame:
    """The ids kept over all runs: those that are the smallest of their group."""
    return index_labels(spark, index).where(F.col("id") == F.col("root")).select(F.col("id").alias(id_col))


def compact_index(spark: SparkSession, index: str, target: str, run: int) -> None:
    """Write a copy of the index, all runs up to ``run`` as that one, to ``target``.

    The old folder is left alone, so a copy that fails costs nothing.
    """
    _write(_smallest(read_runs(spark, f"{index}/heads", HEADS, run + 1), ["band", "bucket"], "head"), target, "heads", run)
    _write(_smallest(read_runs(spark, f"{index}/labels", LABELS, run + 1), ["id"], "root"), target, "labels", run)
