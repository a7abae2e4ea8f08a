"""MinHash signatures and locality-sensitive bands over character shingles."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from srcsieve.constants import CHAR_NGRAMS, HASHES_PER_BAND, MINHASH_SEED, NUM_BANDS
from srcsieve.operators.batches import lists, slices
from srcsieve.operators.joins import attach_group, spread
from srcsieve.session import materialise

SHINGLE_MODULUS = 4_294_967_291  # the largest prime below 2**32
BLOCK = 512  # shingles hashed at a time, so a block of all hashes stays in cache
PIECE = 256  # shingles per piece when they are listed one by one
PART_BYTES = 1 << 20  # text per task that lists shingles, whose sets and sort take some two hundred times its bytes
OWN_PART_BYTES = 2 << 20  # the same where sets are taken text by text, so that only the sort holds them
WINDOW = 1 << 16  # characters taken at a time, so memory does not grow with the text


@lru_cache(maxsize=8)
def hash_parameters(n: int, hashes: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Character weights below 2**31, and odd multipliers and offsets below 2**32."""
    rng = np.random.default_rng(seed)
    weights = rng.integers(1, 1 << 31, n, dtype=np.uint64)
    multipliers = rng.integers(0, 1 << 31, hashes, dtype=np.uint64) * 2 + 1
    offsets = rng.integers(0, 1 << 32, hashes, dtype=np.uint64)
    return weights, multipliers, offsets


class Signer:
    """MinHash of one text at a time, with buffers kept between texts."""

    def __init__(self, n: int, hashes: int, seed: int) -> None:
        self.n = n
        self.weights, multipliers, offsets = hash_parameters(n, hashes, seed)
        self.a = multipliers.astype(np.uint32)[None, :]
        self.b = offsets.astype(np.uint32)[None, :]
        self.block = np.empty((BLOCK, hashes), dtype=np.uint32)

    def shingle_hashes(self, codes: np.ndarray) -> np.ndarray:
        """32-bit hash of every shingle: a weighted sum of code points, then mixed.

        A text shorter than a shingle is one shingle, padded with zeros.
        """
        codes = codes.astype(np.uint64)
        if len(codes) < self.n:
            codes = np.pad(codes, (0, self.n - len(codes)))
        count = len(codes) - self.n + 1
        total, term = np.zeros(count, dtype=np.uint64), np.empty(count, dtype=np.uint64)
        for offset, weight in enumerate(self.weights):
            np.multiply(codes[offset : offset + count], weight, out=term)
            total += term
        h = (total % np.uint64(SHINGLE_MODULUS)).astype(np.uint32)
        h ^= h >> np.uint32(16)
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
        h *= np.uint32(0xC2B2AE35)
        h ^= h >> np.uint32(16)
        return h

    def sign(self, text: str) -> np.ndarray:
        """The minimum of each hash over all shingles of ``text``."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        lowest = np.full(self.block.shape[1], 0xFFFFFFFF, dtype=np.uint32)
        for start in range(0, max(len(codes) - self.n + 1, 1), WINDOW):
            shingles = self.shingle_hashes(codes[start : start + WINDOW + self.n - 1])
            for at in range(0, len(shingles), BLOCK):
                part = shingles[at : at + BLOCK, None]
                permuted = self.block[: len(part)]
                np.multiply(part, self.a, out=permuted)
                np.add(permuted, self.b, out=permuted)
                np.minimum(lowest, permuted.min(axis=0), out=lowest)
        return lowest


def _first_places(data: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Where each distinct shingle of a text first begins, in characters; ``starts`` are the bytes that begin one, and the end.

    Hashes only tell which shingles may occur again; those are compared by their bytes.
    """
    count = max(len(starts) - n, 1)
    if count == 1:
        return np.zeros(1, dtype=np.int64)
    if len(starts) == len(data) + 1:
        codes = data
    else:
        codes = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), dtype="<u4")
    hashes = np.empty(count, dtype=np.uint64)
    for at in range(0, count, WINDOW):
        part = window_hashes(codes[at : min(at + WINDOW, count) + n - 1].astype(np.uint64), n)
        hashes[at : at + len(part)] = part
    ordered = np.sort(hashes)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return np.arange(count)
    known = np.minimum(np.searchsorted(again, hashes), len(again) - 1)
    kept, seen, whole = again[known] != hashes, set(), data.tobytes()
    places = np.flatnonzero(~kept)
    for at, begin, end in zip(places.tolist(), starts[places].tolist(), starts[places + n].tolist()):
        shingle = whole[begin:end]
        if shingle not in seen:
            seen.add(shingle)
            kept[at] = True
    return np.flatnonzero(kept)


def window_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every ``n`` values in a row, from hashes of twice as many at a time."""
    count, taken, width, hashed = len(codes) - n + 1, 0, 1, codes + np.uint64(1)
    total = np.zeros(count, dtype=np.uint64)
    while True:
        if n & width:
            total = total * np.uint64(0xD6E8FEB86659FD93) + hashed[taken : taken + count]
            total ^= total >> np.uint64(32)
            taken += width
        if taken == n:
            return total
        hashed = hashed[: len(hashed) - width] * np.uint64(0x9E3779B97F4A7C15) + hashed[width:]
        hashed ^= hashed >> np.uint64(29)
        width *= 2


def _spelled(data: np.ndarray, starts: np.ndarray, places: np.ndarray, n: int) -> pa.Array:
    """The shingles that begin at ``places``."""
    begins, ends = starts[places], starts[np.minimum(places + n, len(starts) - 1)]
    sizes = ends - begins
    offsets = np.zeros(len(places) + 1, dtype=np.int32)
    np.cumsum(sizes, out=offsets[1:])
    if len(starts) == len(data) + 1 and len(data) >= n:
        letters = np.lib.stride_tricks.sliding_window_view(data, n)[begins].ravel()
    else:
        letters = data[np.repeat(begins - offsets[:-1], sizes) + np.arange(offsets[-1])]
    return pa.StringArray.from_buffers(len(places), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(letters)))


def _shingler(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            held, found, size = [], [], 0
            for row in range(len(texts)):
                value = texts[row].as_buffer()
                data = np.frombuffer(value, dtype=np.uint8) if value is not None else np.zeros(0, np.uint8)
                starts = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
                places = _first_places(data, starts, n)
                for at in range(0, len(places), WINDOW):
                    part = _spelled(data, starts, places[at : at + WINDOW], n)
                    held.append(np.full(len(part), row))
                    found.append(part)
                    size += len(part)
                    if size >= WINDOW:
                        yield _listed(ids, batch.schema.field(0).name, held, found)
                        held, found, size = [], [], 0
            if found:
                yield _listed(ids, batch.schema.field(0).name, held, found)

    return run


def _listed(ids: pa.Array, name: str, held: list[np.ndarray], found: list[pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([ids.take(pa.array(np.concatenate(held))), pa.concat_arrays(found)], names=[name, "shingle"])


def char_shingles(df: DataFrame, id_col: str, n: int = CHAR_NGRAMS, text: str = "text") -> DataFrame:
    """The set of ``n``-character shingles of each text, one row per shingle.

    Short texts are one shingle. Texts move once, to small parts by id, in which sets are taken and may be
    grouped by id: shingles are many times the text. The set of an id with one text is taken
    as the text is read. Texts under one id have one set together, for which their shingles meet in their part.
    """
    narrow = df.select(id_col, text)
    letters = F.coalesce(F.sum(F.octet_length(text).cast("long")), F.lit(0))
    each = narrow.groupBy(id_col).agg(F.count(F.lit(1)).alias("_texts"), letters.alias("_bytes"))
    one, more = F.col("_texts") == 1, F.col("_texts") > 1
    total = lambda rows, of: F.coalesce(F.sum(F.when(rows, of)), F.lit(0))
    ones, size, many, size_many = each.agg(
        total(one, F.lit(1)), total(one, F.col("_bytes")), total(more, F.lit(1)), total(more, F.col("_bytes"))
    ).first()
    if not many:
        return _own_shingles(narrow, id_col, n, text, size)
    if not ones:
        return _joint_shingles(narrow, id_col, n, text, size_many)
    ids = materialise(each.where(more).select(F.col(id_col).alias("_id")), "repeated-ids")
    repeats = narrow[id_col].eqNullSafe(ids["_id"])
    return _own_shingles(narrow.join(ids, repeats, "left_anti"), id_col, n, text, size).unionByName(
        _joint_shingles(narrow.join(ids, repeats, "left_semi"), id_col, n, text, size_many)
    )


def _parts(narrow: DataFrame, size: int, most: int) -> int:
    return max(2 * narrow.sparkSession.sparkContext.defaultParallelism, -(-size // most))


def _own_shingles(narrow: DataFrame, id_col: str, n: int, text: str, size: int) -> DataFrame:
    """Shingles of texts whose ids occur once."""
    listed = T.StructType([narrow.schema[id_col], T.StructField("shingle", T.StringType())])
    moved = narrow.repartition(_parts(narrow, size, OWN_PART_BYTES), id_col)
    return moved.select(id_col, F.coalesce(text, F.lit("")).alias("_text")).mapInArrow(_shingler(n), listed)


def _joint_shingles(narrow: DataFrame, id_col: str, n: int, text: str, size: int) -> DataFrame:
    """Shingles of texts that share ids, of which there may be any number.

    Texts are cut into overlapping pieces first, because taking a substring walks from the start of its string.
    """
    whole = F.coalesce(text, F.lit(""))
    last = F.greatest(F.length(whole) - n, F.lit(0))
    pieces = F.transform(
        F.sequence(F.lit(0), last, F.lit(PIECE)), lambda at: F.substr(whole, at + 1, F.lit(PIECE + n - 1))
    )
    piece = F.col("_piece")
    starts = F.sequence(F.lit(1), F.greatest(F.length(piece) - (n - 1), F.lit(1)))
    shingles = F.transform(starts, lambda at: F.substr(piece, at, F.lit(n)))
    cut = narrow.repartition(_parts(narrow, size, PART_BYTES), id_col).select(id_col, F.explode(pieces).alias("_piece"))
    return cut.select(id_col, F.explode(shingles).alias("shingle")).distinct()


def minhash_signatures(
    df: DataFrame,
    id_col: str,
    text: str = "text",
    keep: tuple[str | Column, ...] = (),
    n: int = CHAR_NGRAMS,
    bands: int = NUM_BANDS,
    rows: int = HASHES_PER_BAND,
    seed: int = MINHASH_SEED,
) -> DataFrame:
    """``(keep, id, signature)`` with ``bands * rows`` 32-bit minima.

    A batch is signed in small parts, so the memory of a worker follows neither its rows nor its signatures.
    """
    hashes = bands * rows

    @F.arrow_udf("array<bigint>")
    def signatures(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        signer = Signer(n, hashes, seed)
        for batch in batches:
            for texts in slices(batch):
                yield lists([signer.sign(text or "").astype(np.int64) for text in texts], pa.int64())

    narrow = df.select(*keep, id_col, text)
    kept = [c for c in narrow.columns if c != text]
    return spread(narrow, id_col).select(*kept, signatures(text).alias("signature"))


def _band_key(band: int, rows: int, scope: tuple[str, ...]) -> Column:
    part = F.slice("signature", band * rows + 1, rows).cast("array<string>")
    scoped = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in scope]
    return F.unhex(F.md5(F.concat_ws(",", *scoped, F.array_join(part, ",")).cast("binary")))


def band_keys(bands: int = NUM_BANDS, rows: int = HASHES_PER_BAND, scope: tuple[str, ...] = ()) -> Column:
    """A 128-bit key per band of ``signature``, in which ``scope`` takes part."""
    return F.array(*[_band_key(b, rows, scope) for b in range(bands)])


def lsh_band_buckets(
    signatures: DataFrame,
    id_col: str,
    bands: int = NUM_BANDS,
    rows: int = HASHES_PER_BAND,
    scope: tuple[str, ...] = (),
) -> DataFrame:
    """``(id, band, bucket)``, one row per band."""
    keys = band_keys(bands, rows, scope)
    return signatures.select(id_col, F.posexplode(keys).alias("band", "bucket"))


def bucket_heads(buckets: DataFrame, id_col: str) -> DataFrame:
    """``(band, bucket, head, members)``: the smallest id of every bucket and its rows."""
    return buckets.groupBy("band", "bucket").agg(F.min(id_col).alias("head"), F.count(F.lit(1)).alias("members"))


def lsh_candidate_edges(buckets: DataFrame, id_col: str, heads: DataFrame | None = None) -> DataFrame:
    """``(id, head)``: each document with the smallest id of every bucket it shares.

    Linear in the size of a bucket: members are tied to the head, not to each other.
    ``buckets`` is read several times and should be a written table; so should the ``bucket_heads``
    of them, for a caller that has these anyway.
    """
    heads = bucket_heads(buckets, id_col) if heads is None else heads
    tied = attach_group(buckets, heads.where(F.col("members") > 1), ["band", "bucket"], "members")
    return tied.where(F.col(id_col) != F.col("head")).select(id_col, "head").distinct()


def document_buckets(
    df: DataFrame, id_col: str, text: str = "text", scope: tuple[str, ...] = (), **params: int
) -> DataFrame:
    """Band buckets of every document, written so that signatures are computed once."""
    shape = {k: v for k, v in params.items() if k in ("bands", "rows")}
    signatures = minhash_signatures(df, id_col, text, keep=scope, **params)
    return materialise(lsh_band_buckets(signatures, id_col, scope=scope, **shape), "buckets")
