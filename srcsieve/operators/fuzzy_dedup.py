"""Near duplicates: shared buckets, transitive groups, one survivor per group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from srcsieve.constants import CHAR_NGRAMS
from srcsieve.operators.batches import slices
from srcsieve.operators.components import duplicate_components
from srcsieve.operators.exact_dedup import ID_KEYS, Removal, add_doc_id, exact_removal, text_digest
from srcsieve.operators.joins import HOT_KEY_ROWS, drop_ids, lookup_join
from srcsieve.operators.minhash import band_keys, document_buckets, lsh_candidate_edges, minhash_signatures
from srcsieve.session import materialise

SCOPES = {"batch": ("month", "batch"), "month": ("month",), "global": ()}


def distinct(values: np.ndarray) -> np.ndarray:
    """``values`` sorted, each once; the sort is in place."""
    values.sort()
    fresh = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=fresh[1:])
    return values[fresh]


def shared_values(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted arrays of distinct, at least one each, have in common."""
    if len(a) > len(b):
        a, b = b, a
    return int(np.count_nonzero(b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a))


class ShingleSets:
    """Distinct ``n``-character shingles of a text as sorted 64-bit hashes.

    A hash is a weighted sum of code points, mixed. Windows bound the scratch memory, so a
    text takes eight bytes per distinct shingle.
    """

    def __init__(self, n: int, window: int = 1 << 20) -> None:
        self.n, self.window = n, window
        self.weights = np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def hashes(self, codes: np.ndarray) -> np.ndarray:
        count = len(codes) - self.n + 1
        total = np.zeros(count, dtype=np.uint64)
        for offset, weight in enumerate(self.weights):
            total += codes[offset : offset + count] * weight
        total ^= total >> np.uint64(31)
        total *= np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
        return distinct(total)

    def of(self, text: str) -> np.ndarray:
        """A text shorter than a shingle is one shingle, padded past the last code point."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1)
        if len(codes) < self.n:
            codes = np.pad(codes, (0, self.n - len(codes)))
        last = len(codes) - self.n + 1
        parts = [self.hashes(codes[at : at + self.window + self.n - 1]) for at in range(0, last, self.window)]
        return parts[0] if len(parts) == 1 else distinct(np.concatenate(parts))


def near_duplicate_pairs(
    edges: DataFrame,
    docs: DataFrame,
    id_col: str = "id",
    text: str = "text",
    threshold: float = 0.8,
    n: int = CHAR_NGRAMS,
    hot_key_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Edges whose documents share enough shingles, with their Jaccard index over all shingles.

    This is the optional check of candidates: each is compared with the head of its
    bucket. A head with very many members is copied, so its members meet it in many tasks.
    """

    @F.arrow_udf("double")
    def jaccard(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        shingles, head, head_set = ShingleSets(n), None, None
        for batch in batches:
            for left, right in zip(slices(batch[0]), slices(batch[1])):
                scores = []
                for a, b in zip(left, right):
                    if head_set is None or b != head:  # members of a head come one after the other
                        head, head_set = b, shingles.of(b or "")
                    own = shingles.of(a or "")
                    shared = shared_values(own, head_set)
                    scores.append(shared / (len(own) + len(head_set) - shared))
                yield pa.array(scores, type=pa.float64())

    # The ends of the edges come to the texts, which then move once per edge, to their head.
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    heads = edges.groupBy("head").agg(F.floor(F.count(F.lit(1)) / hot_key_rows).cast("long").alias("_more"))
    heads = materialise(heads, "heads")
    copies = (
        lookup_join(texts, heads.withColumnRenamed("head", "_id"), ["_id"])
        .select(F.col("_id").alias("head"), F.col("_text").alias("_head_text"), F.explode(F.sequence(F.lit(0), "_more")).alias("_salt"))
    )
    salted = edges.join(F.broadcast(heads.where(F.col("_more") > 0)), "head", "left").withColumn(
        "_salt", F.pmod(F.xxhash64(id_col), F.coalesce(F.col("_more") + 1, F.lit(1))).cast("int")
    )
    ends = salted.groupBy(F.col(id_col).alias("_id")).agg(F.collect_list(F.struct("head", "_salt")).alias("_ends"))
    members = lookup_join(texts, ends, ["_id"]).select(F.col("_id").alias(id_col), "_text", F.inline("_ends"))
    pairs = members.join(copies.withColumn("_salt", F.col("_salt").cast("int")), ["head", "_salt"])
    scored = pairs.select(id_col, "head", jaccard("_text", "_head_text").alias("jaccard"))
    return scored.where(F.col("jaccard") >= threshold)


def fuzzy_duplicates(
    df: DataFrame,
    id_col: str = "my_id",
    text: str = "text",
    scope: tuple[str, ...] = (),
    false_positive_check: bool = False,
    threshold: float = 0.8,
    **params: int,
) -> DataFrame:
    """``(id, root)`` of every document to remove: all but the smallest id of its group."""
    buckets = document_buckets(df, id_col, text, scope, **params)
    edges = lsh_candidate_edges(buckets, id_col)
    if false_positive_check:
        edges = materialise(edges, "candidates")
        edges = near_duplicate_pairs(edges, df, id_col, text, threshold, params.get("n", CHAR_NGRAMS))
    return duplicate_components(edges, id_col)


def fuzzy_dedup(
    df: DataFrame, id_col: str = "my_id", text: str = "text", scope: tuple[str, ...] = (), **options
) -> DataFrame:
    """Keep one document of each group of near duplicates within ``scope``."""
    return drop_ids(df, fuzzy_duplicates(df, id_col, text, scope, **options), id_col)


def deduplicate(
    df: DataFrame, scope: str = "global", id_col: str = "my_id", text: str = "text", **params: int
) -> DataFrame:
    """Add an id, drop exact copies, then drop near copies among the survivors.

    ``scope`` is ``global``, ``month``, or ``batch`` (one output file). The corpus is read
    twice: one pass takes digests and band keys of every text, all matching is done on
    that narrow table, and a second pass drops rows. Exact copies are signed too, which
    costs less than moving their texts apart first.
    """
    columns = SCOPES[scope]
    identified = add_doc_id(df, id_col, (*columns, *ID_KEYS))
    shape = {k: v for k, v in params.items() if k in ("bands", "rows")}
    signed = minhash_signatures(identified, id_col, text, keep=(*columns, text_digest(text)), **params)
    prints = materialise(signed.withColumn("keys", band_keys(scope=columns, **shape)).drop("signature"), "prints")
    exact = exact_removal(prints, id_col, columns)
    exact = exact._replace(removed=materialise(exact.removed, "removed"))
    survivors = materialise(prints.select(id_col, "keys").join(exact.removed, id_col, "left_anti"), "survivors")
    buckets = survivors.select(id_col, F.posexplode("keys").alias("band", "bucket"))
    near = duplicate_components(lsh_candidate_edges(buckets, id_col), id_col)
    every = exact.removed.unionByName(near.select(id_col))
    return Removal(every, exact.twins.join(near, id_col, "left_anti")).apply(identified, id_col, columns)
