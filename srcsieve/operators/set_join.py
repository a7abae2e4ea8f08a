"""Exact similarity of shingle sets: which documents are linked at a Jaccard index of ``threshold`` or more.

Shingles have one order for all documents. Two sets that are similar enough share one in their prefixes, so documents
meet on prefix shingles, and length, position and a histogram of the sets rule out most pairs before any text is
compared. Any order gives the same links; in this one, common shingles come last, so that prefixes seldom meet on them.
A task that holds a text takes its prefix, so no other shingle leaves it. Families of near copies would still give all
their pairs, so documents are compared twice:

1. every document is compared with the head of each shingle it shares, which is linear, and linked ones
   form groups;
2. only pairs of documents of different groups are listed, per shingle and pair of groups, and compared.

A link that neither step compared lies within a group already, so the groups are those of the full graph.
Candidates need no signatures, so the recall of MinHash bands can be measured against them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from srcsieve.constants import CHAR_NGRAMS
from srcsieve.operators.batches import lists, slices
from srcsieve.operators.components import duplicate_components
from srcsieve.operators.fuzzy_dedup import ShingleSets, near_duplicate_pairs
from srcsieve.operators.joins import HOT_KEY_ROWS, attach_group, lookup_join, spread
from srcsieve.session import free_shuffles, materialise

#: Slots of the histogram that bounds the overlap of two sets.
SLOTS = 32
#: About so many documents are looked at to learn which shingles are common, and so many of those are listed at most.
#: The list decides the order of shingles only; every document and shingle takes part whatever is on it.
ORDER_DOCUMENTS = 8192
MAX_COMMON = 1 << 18
COMMON_HOLDERS = 3
#: Prefix shingles that a task packs at a time, that meet in one part, and rows of a batch that comes of them.
BLOCK_KEYS = 1 << 21
PART_KEYS = 1 << 22
OUT_ROWS = 100_000


def shingle_sets(docs: DataFrame, id_col: str, text: str = "text", n: int = CHAR_NGRAMS) -> DataFrame:
    """``(id, shingles)``: the distinct ``n``-character shingles as 64-bit hashes; a null text counts as empty."""

    @F.arrow_udf("array<bigint>")
    def hashes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        sets = ShingleSets(n)
        for batch in batches:
            for texts in slices(batch):
                yield lists([sets.of(text or "").view(np.int64) for text in texts], pa.int64())

    narrow = spread(docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")), "id")
    return narrow.select("id", hashes("text").alias("shingles"))


def least_overlap(size: Column, threshold: float) -> Column:
    """How many shingles a set of ``size`` shares at least with any set similar to it."""
    return F.ceil(size * threshold - 1e-9)


def common_shingles(docs: DataFrame, documents: int, n: int = CHAR_NGRAMS) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that many documents hold, ascending, and how many of the documents looked at do; a bounded list."""
    every = -(-documents // ORDER_DOCUMENTS) or 1
    seen = docs.where(F.pmod(F.xxhash64("id"), F.lit(every)) == 0)
    counted = shingle_sets(seen, "id", "text", n).select(F.explode("shingles").alias("shingle")).groupBy("shingle").count()
    most = counted.where(F.col("count") >= COMMON_HOLDERS).orderBy(F.desc("count"), "shingle").limit(MAX_COMMON).collect()
    listed = np.array([(r[0], r[1]) for r in most], dtype=np.int64).reshape(-1, 2)
    shingles = listed[:, 0].view() if not len(listed) else np.ascontiguousarray(listed[:, 0])
    order = np.argsort(shingles.view(np.uint64))
    return shingles.view(np.uint64)[order], listed[order, 1]


def _ordered(own: np.ndarray, common: np.ndarray, holders: np.ndarray) -> np.ndarray:
    """The ascending shingles ``own`` in the order of all documents: common ones last, by their ``holders``."""
    if not len(common):
        return own
    at = np.minimum(np.searchsorted(common, own), len(common) - 1)
    known = common[at] == own
    last = own[known]
    return np.concatenate([own[~known], last[np.lexsort((last, holders[at[known]]))]])


def outlines(
    docs: DataFrame, threshold: float, common: tuple[np.ndarray, np.ndarray], n: int = CHAR_NGRAMS
) -> DataFrame:
    """``(id, size, slots, prefix)`` of each ``(id, text)``: its number of shingles, their histogram and its prefix.

    A set shares at least ``least_overlap`` shingles with any similar one, so of those it may miss and one more
    at least one is shared, wherever they come from; the prefix holds the first of them.
    """
    shape = "struct<size: int, slots: array<int>, prefix: array<bigint>>"

    @F.arrow_udf(shape)
    def outline(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        sets = ShingleSets(n)
        for batch in batches:
            for texts in slices(batch):
                sizes, slots, firsts = [], [], []
                for text in texts:
                    own = sets.of(text or "")
                    sizes.append(len(own))
                    slots.append(np.bincount((own % np.uint64(SLOTS)).astype(np.int64), minlength=SLOTS))
                    most = len(own) - int(np.ceil(len(own) * threshold - 1e-9)) + 1
                    firsts.append(_ordered(own, *common)[:most].view(np.int64))
                arrays = [pa.array(sizes, type=pa.int32()), lists(slots, pa.int32()), lists(firsts, pa.int64())]
                yield pa.StructArray.from_arrays(arrays, names=["size", "slots", "prefix"])

    return spread(docs.select("id", "text"), "id").select("id", outline("text").alias("o")).select("id", "o.*")


def packed_prefixes(drawn: DataFrame, parts: int) -> DataFrame:
    """Prefixes of ``drawn (id, size, prefix)`` by part of the shingles: per block of documents and part one row of arrays.

    A shingle takes four bytes, which with its part tell it from others well enough for candidates, and one for its place.
    """

    def pack(ids: pa.Array, sizes: np.ndarray, held: np.ndarray, keys: np.ndarray) -> Iterator[tuple]:
        document = np.repeat(np.arange(len(held), dtype=np.int32), held)
        place = np.arange(len(keys)) - np.repeat(np.cumsum(held) - held, held)
        place = (place * 256 // sizes[document]).astype(np.uint8)
        part = (keys % np.uint64(parts)).astype(np.uint32)
        order = np.argsort(part, kind="stable")
        document, place, ordered = document[order], place[order], part[order]
        rest = (keys[order] // np.uint64(parts)).astype(np.uint32)
        bounds = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        for begin, end in zip(bounds.tolist(), [*bounds[1:].tolist(), len(ordered)]):
            own = document[begin:end]
            first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            counts = np.diff(np.append(first, len(own))).astype(np.int32)
            named = own[first]
            yield (int(ordered[begin]), ids.take(pa.array(named)), sizes[named].astype(np.int32).tobytes(),
                   counts.tobytes(), rest[begin:end].tobytes(), place[begin:end].tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed() -> Iterator[pa.RecordBatch]:
            rows = list(pack(pa.concat_arrays(ids), *map(np.concatenate, (sizes, held, keys))))
            columns = [*zip(*rows)]
            ends = np.append(0, np.cumsum([len(r[1]) for r in rows])).astype(np.int32)
            arrays = [pa.array(columns[0], type=pa.int32()), pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays(columns[1])),
                      *(pa.array(c, type=pa.binary()) for c in columns[2:])]
            yield pa.RecordBatch.from_arrays(arrays, names=["part", "ids", "sizes", "held", "rest", "places"])

        ids, sizes, held, keys, waiting = [], [], [], [], 0
        for batch in batches:
            prefix = batch.column(2)
            ids.append(batch.column(0))
            sizes.append(batch.column(1).to_numpy().astype(np.int64))
            held.append(np.diff(prefix.offsets.to_numpy()))
            keys.append(prefix.flatten().to_numpy().view(np.uint64))
            waiting += len(keys[-1])
            if waiting >= BLOCK_KEYS:
                yield from packed()
                ids, sizes, held, keys, waiting = [], [], [], [], 0
        if waiting:
            yield from packed()

    shape = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("ids", T.ArrayType(drawn.schema["id"].dataType)),
        *T.StructType.fromDDL("sizes binary, held binary, rest binary, places binary"),
    ])
    return drawn.select("id", "size", "prefix").mapInArrow(run, shape)


def _meeting(threshold: float):
    """What the shingles of one part give: pairs with the heads of shared ones, and all holders of those with three or more."""

    def met(part: int, blocks: list[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
        join = lambda name, kind: np.concatenate([np.frombuffer(x.as_buffer(), kind) for b in blocks for x in b.column(name)])
        ids = pa.concat_arrays([b.column("ids").flatten() for b in blocks])
        sizes, held, rest, places = join("sizes", np.int32), join("held", np.int32), join("rest", np.uint32), join("places", np.uint8)
        document = np.repeat(np.arange(len(ids), dtype=np.int32), held)
        by_rank = pc.sort_indices(ids).to_numpy().astype(np.int64)
        rank = np.empty(len(ids), dtype=np.int64)
        rank[by_rank] = np.arange(len(ids))
        order = np.argsort(rest)
        rest, document, places = rest[order], document[order], places[order]
        first = np.flatnonzero(np.append(True, rest[1:] != rest[:-1]))
        holders = np.diff(np.append(first, len(rest)))
        least = by_rank[np.minimum.reduceat(rank[document], first)]
        head, many = np.repeat(least, holders), np.repeat(holders > 2, holders)
        named = ids.dictionary_encode()
        code = named.indices.to_numpy()
        apart = code[head] != code[document]  # an id may stand in several rows
        codes = np.unique(document[apart].astype(np.int64) * len(ids) + head[apart])
        ours, heads = codes // len(ids), codes % len(ids)
        if len(named.dictionary) == len(ids):  # else a head has several lengths
            least, most = np.minimum(sizes[ours], sizes[heads]), np.maximum(sizes[ours], sizes[heads])
            alike = least >= most * threshold - 1e-9
            ours, heads = ours[alike], heads[alike]
        no = lambda kind, n: pa.nulls(n, kind)
        for at in range(0, len(ours), OUT_ROWS):
            a, b = ours[at : at + OUT_ROWS], heads[at : at + OUT_ROWS]
            columns = [no(pa.int64(), len(a)), ids.take(pa.array(a)), no(pa.int32(), len(a)), no(pa.int32(), len(a)), ids.take(pa.array(b))]
            yield pa.RecordBatch.from_arrays(columns, names=["shingle", "id", "size", "place", "head"])
        rest, document, places = rest[many], document[many], places[many]
        for at in range(0, len(rest), OUT_ROWS):
            own = document[at : at + OUT_ROWS]
            size = sizes[own]
            place = (places[at : at + OUT_ROWS].astype(np.int64) * size >> 8).astype(np.int32)
            shingle = rest[at : at + OUT_ROWS].astype(np.int64) * parts + part
            columns = [pa.array(shingle), ids.take(pa.array(own)), pa.array(size), pa.array(place), no(ids.type, len(own))]
            yield pa.RecordBatch.from_arrays(columns, names=["shingle", "id", "size", "place", "head"])

    return met


def prefix_meetings(drawn: DataFrame, threshold: float, parts: int) -> tuple[DataFrame, DataFrame]:
    """``(id, head)`` of documents with the smallest id of each shared prefix shingle, where lengths allow a link, and the
    rows ``(shingle, id, size, place)`` of shingles with three holders or more: of two holders one is the head.

    Shingles are moved once, packed. A place is a lower bound of the real one.
    """
    met = _meeting(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blocks = None, []
        for batch in batches:
            of = batch.column(0).to_numpy()
            for begin, end in pairwise([*np.flatnonzero(np.append(True, of[1:] != of[:-1])).tolist(), len(of)]):
                if blocks and of[begin] != part:
                    yield from met(part, blocks, parts)
                    blocks = []
                part = int(of[begin])
                blocks.append(batch.slice(begin, end - begin))
        if blocks:
            yield from met(part, blocks, parts)

    kind = drawn.schema["id"].dataType
    shape = T.StructType([
        T.StructField("shingle", T.LongType()), T.StructField("id", kind), *T.StructType.fromDDL("size int, place int"),
        T.StructField("head", kind),
    ])
    moved = packed_prefixes(drawn, parts).repartition(parts, "part").sortWithinPartitions("part")
    found = materialise(moved.mapInArrow(run, shape), "meetings")
    pairs = found.where(F.col("shingle").isNull()).select("id", "head").distinct()
    return pairs, found.where(F.col("shingle").isNotNull()).drop("head")


def _cross_pairs(rows: DataFrame, shapes: DataFrame, threshold: float, hot_key_rows: int) -> DataFrame:
    """``(id, head)``: pairs of different groups that length, position and histogram allow.

    ``rows`` is ``(shingle, id, size, place, root)``. Shingles of one group only are left out first; for the others,
    pairs of groups are listed before their members, so no two members of a group ever meet.
    """
    mixed = rows.groupBy("shingle").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least < most")
    rows = lookup_join(rows, mixed.select("shingle"), ["shingle"], "left_semi", hot_key_rows=hot_key_rows)
    rows = materialise(rows, "mixed")
    groups = materialise(rows.groupBy("shingle", "root").agg(F.count(F.lit(1)).alias("members")), "groups")
    left = groups.select("shingle", F.col("root").alias("root"), F.col("members"))
    right = groups.select("shingle", F.col("root").alias("other"))
    paired = left.join(right, "shingle").where(F.col("root") < F.col("other"))
    ours = attach_group(rows, paired, ["shingle", "root"], "members", hot_key_rows)
    theirs = rows.select("shingle", F.col("root").alias("other"), F.col("id").alias("head"),
                         F.col("size").alias("head_size"), F.col("place").alias("head_place"))
    met = ours.join(theirs, ["shingle", "other"])
    overlap = F.ceil((F.col("size") + F.col("head_size")) * (threshold / (1 + threshold)) - 1e-9)
    after = F.least(F.col("size") - F.col("place"), F.col("head_size") - F.col("head_place"))
    lengths = F.least("size", "head_size") >= F.greatest("size", "head_size") * threshold - 1e-9
    pairs = met.where(lengths & (after >= overlap)).select("id", "head", overlap.alias("overlap")).distinct()
    return _possible(pairs, shapes).select("id", "head")


def _possible(pairs: DataFrame, shapes: DataFrame) -> DataFrame:
    """``pairs (id, head, overlap)`` whose histograms leave room for that overlap."""
    shape = lambda name: shapes.select(F.col("id").alias(name), F.col("size").alias(f"{name}_n"), F.col("slots").alias(f"{name}_s"))
    shaped = pairs.join(shape("id"), "id").join(shape("head"), "head")
    apart = F.aggregate(F.zip_with("id_s", "head_s", lambda a, b: F.abs(a - b)), F.lit(0), lambda a, b: a + b)
    return shaped.where(apart <= F.col("id_n") + F.col("head_n") - 2 * F.col("overlap"))


def _head_pairs(met: DataFrame, shapes: DataFrame, threshold: float) -> DataFrame:
    """Those of the pairs ``(id, head)`` whose lengths and histograms allow a link."""
    sizes = shapes.select(F.col("id").alias("_id"), F.col("size").alias("n"))
    ours = met.join(sizes, met["id"] == sizes["_id"]).select("id", "head", "n")
    theirs = sizes.select(F.col("_id").alias("head"), F.col("n").alias("head_n"))
    lengths = F.least("n", "head_n") >= F.greatest("n", "head_n") * threshold - 1e-9
    overlap = F.ceil((F.col("n") + F.col("head_n")) * (threshold / (1 + threshold)) - 1e-9)
    alike = ours.join(theirs, "head").where(lengths).select("id", "head", overlap.alias("overlap"))
    return _possible(alike, shapes).select("id", "head")


def _labelled(rows: DataFrame, links: DataFrame, hot_key_rows: int) -> DataFrame:
    """``rows`` with the ``root`` of the group that each ``id`` has by ``links (id, head)``."""
    roots = duplicate_components(links, "id", "head", hot_key_rows=hot_key_rows)
    return lookup_join(rows, roots, ["id"], "left", hot_key_rows=hot_key_rows).withColumn("root", F.coalesce("root", "id"))


def similarity_groups(
    docs: DataFrame,
    id_col: str = "id",
    text: str = "text",
    threshold: float = 0.8,
    n: int = CHAR_NGRAMS,
    hot_key_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """``(id, root, partner, jaccard)`` of every document that is linked to another.

    ``root`` is the smallest id that links of ``threshold`` or more lead to. ``partner`` is the document most like it
    among those it was compared with, with their exact Jaccard index over all shingles. Equal texts are one
    document here, whose copies have it as their partner; a null text counts as an empty one. Ids are unique;
    rows with a null id are left out. A table without links gives an empty one.
    """
    named = docs.where(docs[id_col].isNotNull()).select(docs[id_col].alias("id"), docs[text].alias("text"))
    digest = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    digests = materialise(named.select("id", digest.alias("digest")), "digests")
    texts = digests.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
    tied = attach_group(digests, texts.where("copies > 1"), ["digest"], "copies", hot_key_rows)
    copies = materialise(tied.where("id <> first").select("id", F.col("first").alias("partner")), "copies")
    distinct = lookup_join(named, copies.select("id"), ["id"], "left_anti")

    common = common_shingles(distinct, digests.count(), n)
    drawn = outlines(distinct, threshold, common, n)
    shapes = materialise(drawn.select("id", "size", "slots"), "outlines")  # without prefixes: those are taken again as they move
    keys = shapes.agg(F.coalesce(F.sum(F.col("size") - least_overlap(F.col("size"), threshold) + 1), F.lit(0))).first()[0]
    parts = max(2 * docs.sparkSession.sparkContext.defaultParallelism, -(-int(keys) // PART_KEYS))
    spark = docs.sparkSession
    free_shuffles(spark)  # each step may need the disk of the one before
    heads, rows = prefix_meetings(drawn, threshold, parts)
    free_shuffles(spark)
    first = materialise(_head_pairs(heads, shapes, threshold), "head-pairs")
    first = materialise(near_duplicate_pairs(first, distinct, "id", "text", threshold, n, hot_key_rows), "head-links")
    free_shuffles(spark)

    labelled = materialise(_labelled(rows, first, hot_key_rows), "labelled")
    pairs = materialise(_cross_pairs(labelled, shapes, threshold, hot_key_rows), "cross-pairs")
    free_shuffles(spark)
    second = near_duplicate_pairs(pairs, distinct, "id", "text", threshold, n, hot_key_rows)
    links = materialise(first.unionByName(second), "links")

    both = links.unionByName(links.select(F.col("head").alias("id"), F.col("id").alias("head"), "jaccard"))
    best = both.groupBy("id").agg(F.max(F.struct("jaccard", "head")).alias("best"))
    of_texts = best.select("id", F.col("best.head").alias("partner"), F.col("best.jaccard").alias("jaccard"))
    of_copies = copies.select("id", "partner", F.lit(1.0).alias("jaccard"))
    heads = of_copies.groupBy(F.col("partner").alias("id")).agg(F.min("id").alias("partner")).withColumn("jaccard", F.lit(1.0))
    heads = heads.join(of_texts.select("id"), "id", "left_anti")
    edges = links.select("id", "head").unionByName(copies.select("id", F.col("partner").alias("head")))
    every = materialise(of_texts.unionByName(of_copies).unionByName(heads), "partners")
    return _labelled(every, edges, hot_key_rows).select(F.col("id").alias(id_col), "root", "partner", "jaccard")


def band_recall(docs: DataFrame, groups: DataFrame, links: DataFrame, id_col: str = "id") -> DataFrame:
    """How much of the exact ``groups`` the near-duplicate ``links (id, root)`` of MinHash bands find.

    One row: ``linked``, the documents that are not the root of their exact group, ``found``, those of them that
    the bands tie to the same group, and ``extra``, documents that only the bands remove.
    """
    exact = groups.where(F.col(id_col) != F.col("root")).select(id_col, F.col("root").alias("exact"))
    mine = links.select(id_col, F.col("root").alias("banded"))
    both = docs.select(id_col).join(exact, id_col, "left").join(mine, id_col, "left")
    count = lambda condition: F.count(F.when(condition, 1))
    return both.agg(
        count(F.col("exact").isNotNull()).alias("linked"),
        count(F.col("exact").isNotNull() & F.col("banded").isNotNull()).alias("found"),
        count(F.col("exact").isNull() & F.col("banded").isNotNull()).alias("extra"),
    )
