"""Vector codes: product quantisation with exact nearest entries from slice-and-intersect bit masks.

A vector is cut into parts, and each part is coded by the nearest of its codebook's entries. Along every
coordinate the entries are sorted, and a mask of 64-bit words says which entries lie before each place. An
initial radius, the distance to an entry that is close in one coordinate, cuts a slice from each
coordinate; the difference of two prefix masks is the entries of a slice, and their intersection over all
coordinates holds every entry that can be nearest. Only those are measured, in whole numbers.

A round of training is one pass: tasks add up the parts of each entry, and only sums of the size of the
codebooks come back.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from srcsieve.operators.joins import lookup_join
from srcsieve.session import materialise

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Rows measured at a time.
BLOCK = 1 << 14


class Slices:
    """Nearest entries of one codebook, an integer array ``(entries, coordinates)``."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        n, width = entries.shape
        self.order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(entries, self.order, axis=0).T)
        self.masks = np.zeros((width, n + 1, -(-n // 64)), dtype=np.uint64)  # entries before each place
        for place in range(n):
            own = self.order[place]
            self.masks[:, place + 1] = self.masks[:, place]
            self.masks[np.arange(width), place + 1, own // 64] |= np.uint64(1) << (own % 64).astype(np.uint64)

    def radius(self, points: np.ndarray) -> np.ndarray:
        """A whole number at or above each point's distance to some entry: the nearer of two, each close in
        one of the two coordinates that spread the entries most."""
        least = None
        for axis in np.argsort(-np.ptp(self.entries, axis=0), kind="stable")[:2]:
            place = np.minimum(np.searchsorted(self.sorted[axis], points[:, axis]), len(self.entries) - 1)
            far = ((points - self.entries[self.order[place, axis]]) ** 2).sum(axis=1)
            least = far if least is None else np.minimum(least, far)
        return np.sqrt(least.astype(np.float64)).astype(np.int64) + 1  # rounding errs by less than one

    def candidates(self, points: np.ndarray) -> np.ndarray:
        """A mask per point of all entries that can be its nearest."""
        radius = self.radius(points)
        found = np.full((len(points), self.masks.shape[2]), ~np.uint64(0))
        for axis, (ordered, masks) in enumerate(zip(self.sorted, self.masks)):
            low = np.searchsorted(ordered, points[:, axis] - radius, "left")
            high = np.searchsorted(ordered, points[:, axis] + radius, "right")
            found &= masks[high] ^ masks[low]
        return found

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry, the lowest of equals, and its squared distance."""
        into, least = np.zeros(len(points), np.int64), np.full(len(points), np.iinfo(np.int64).max)
        if points.shape[1] == 0:
            return into, np.zeros(len(points), np.int64)
        masks = self.candidates(points)
        for entry, place in enumerate(self.entries):
            rows = np.flatnonzero(masks[:, entry // 64] >> np.uint64(entry % 64) & np.uint64(1))
            far = ((points[rows] - place) ** 2).sum(axis=1)
            closer = far < least[rows]
            into[rows[closer]], least[rows[closer]] = entry, far[closer]
        return into, least


def codebooks_sha256(codebooks: np.ndarray) -> str:
    """Digest of all components by part, entry and place, as decimal numbers with commas."""
    return hashlib.sha256(",".join(map(str, codebooks.reshape(-1).tolist())).encode()).hexdigest()


def _matrix(column: pa.Array, codebooks: np.ndarray) -> np.ndarray:
    """The vectors of a batch as ``(rows, parts, width)``."""
    parts, _, width = codebooks.shape
    return column.flatten().to_numpy().astype(np.int64).reshape(len(column), parts, width)


def _assign(vectors: np.ndarray, slices: list[Slices]) -> tuple[np.ndarray, np.ndarray]:
    found = [own.nearest(vectors[:, part]) for part, own in enumerate(slices)]
    return np.stack([into for into, _ in found], axis=1), np.stack([far for _, far in found], axis=1)


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int = SCALE) -> DataFrame:
    """``(id, label, vector)`` with components ``floor(scale * x)``; rows that are null or hold null or
    non-finite components go."""
    vector = df[vector_col]
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    kept = df.where(vector.isNotNull() & finite)
    return kept.select(df[id_col].alias("id"), df[label_col].alias("label"), whole.alias("vector"))


def _width(vectors: DataFrame, parts: int) -> int:
    """Components of a part; raises for vectors that cannot be cut alike or whose distances exceed a long."""
    size = F.size("vector")
    least, most, low, high = vectors.agg(
        F.min(size), F.max(size), F.min(F.array_min("vector")), F.max(F.array_max("vector"))
    ).first()
    if least is None:
        return 0
    if least != most or least % parts:
        raise ValueError(f"vectors of {least} to {most} components do not fall into {parts} equal parts")
    if max(abs(low or 0), abs(high or 0)) > math.isqrt((1 << 61) // max(most, 1)):
        raise ValueError("squared distances of such large components exceed a 64-bit integer")
    return most // parts


def first_codebooks(vectors: DataFrame, parts: int, entries: int, width: int) -> np.ndarray:
    """The parts of the vectors with the smallest ids, as ``(parts, entries, width)``; a bounded top-k."""
    rows = vectors.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    seeds = np.array([row["vector"] for row in rows], dtype=np.int64).reshape(len(rows), parts, width)
    return np.ascontiguousarray(seeds.transpose(1, 0, 2))


def _summer(codebooks: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, width = codebooks.shape
        slices = [Slices(own) for own in codebooks]
        sums = np.zeros((parts, entries, width), dtype=np.int64)
        counts = np.zeros((parts, entries), dtype=np.int64)
        for batch in batches:
            whole = _matrix(batch.column(0), codebooks)
            for at in range(0, len(whole), BLOCK):
                vectors = whole[at : at + BLOCK]
                into, _ = _assign(vectors, slices)
                for part in range(parts):
                    np.add.at(sums[part], into[:, part], vectors[:, part])
                    counts[part] += np.bincount(into[:, part], minlength=entries)
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(part.astype(np.int32)), "entry": pa.array(entry.astype(np.int32)),
            "n": pa.array(counts[part, entry]),
            "total": pa.array(sums[part, entry].tolist(), pa.list_(pa.int64())),
        })

    return run


def train(vectors: DataFrame, codebooks: np.ndarray, rounds: int) -> np.ndarray:
    """``codebooks`` after ``rounds``, each a pass over ``vectors`` (a written table).

    Every entry becomes the floored mean of its parts; one that no part chose stays. What comes back
    is one number per component of the codebooks, summed as decimals, so no corpus overflows it.
    """
    for _ in range(rounds):
        sums = vectors.select("vector").mapInArrow(
            _summer(codebooks), "part int, entry int, n long, total array<long>"
        )
        places = sums.select("part", "entry", "n", F.posexplode("total").alias("place", "own"))
        found = places.groupBy("part", "entry", "place").agg(
            F.sum(F.col("own").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")
        )
        codebooks = codebooks.copy()
        for row in found.collect():  # as many rows as the codebooks have components
            codebooks[row["part"], row["entry"], row["place"]] = int(row["total"]) // row["n"]
    return codebooks


def _coder(codebooks: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [Slices(own) for own in codebooks]
        for batch in batches:
            whole = _matrix(batch.column(2), codebooks)
            for at in range(0, len(whole), BLOCK):
                into, far = _assign(whole[at : at + BLOCK], slices)
                codes = [row.tobytes() for row in into.astype(np.uint8)]
                part = batch.slice(at, BLOCK)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(codes, pa.binary()), pa.array(far.sum(axis=1))],
                    names=["id", "label", "code", "error"],
                )

    return run


def compress(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """``(id_col, label_col, code, error)`` of every vector, and the codebooks ``(parts, entries, width)``.

    ``code`` holds one byte per part, the index of its entry; ``error`` is the squared distance summed over the parts, in
    units of ``1 / scale``. Codebooks start as the parts of the vectors with the smallest ids.

    Vectors that are null or hold null or non-finite components are dropped. Null ids are coded like others but
    start a codebook last; rows with one id are ordered by their vectors and all coded. With fewer vectors than entries
    the codebooks are smaller, and an empty table gives an empty one. Vectors of different lengths, of a length that
    ``parts`` does not divide, or too large for 64-bit distances raise ``ValueError``. Other columns are not read.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte per part: 1 to 256 entries")
    vectors = materialise(integer_vectors(df, id_col, vector_col, label_col, scale), "vectors")
    codebooks = first_codebooks(vectors, parts, entries, _width(vectors, parts))
    if codebooks.shape[1]:
        codebooks = train(vectors, codebooks, rounds)
    schema = vectors.drop("vector").withColumns({"code": F.lit(b""), "error": F.lit(0).cast("long")}).schema
    coded = vectors.mapInArrow(_coder(codebooks), schema)
    return coded.withColumnsRenamed({"id": id_col, "label": label_col}), codebooks


def with_label_error(coded: DataFrame, label_col: str = "label", error_col: str = "error") -> DataFrame:
    """Adds ``label_error``, the errors of all rows with an equal label, nulls together.

    Errors are added up per label before any row moves; rows meet the sums by ``lookup_join``, so a label
    with a third of all rows stays in place. Labels compare by their text.
    """
    coded = materialise(coded, "codes")
    keyed = coded.withColumn("_label", F.coalesce(F.concat(F.lit("="), F.col(label_col).cast("string")), F.lit("")))
    sums = keyed.groupBy("_label").agg(F.sum(error_col).alias("label_error"))
    return lookup_join(keyed, sums, ["_label"]).drop("_label")


def reconstruct(codes: np.ndarray, codebooks: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The vectors that ``codes`` ``(rows, parts)`` stand for."""
    parts = np.arange(codebooks.shape[0])
    return codebooks[parts, codes].reshape(len(codes), -1) / scale


def oracle_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """DuckDB SQL of the query over ``embeddings``: all entries measured for every part."""
    book = "book0 AS MATERIALIZED (SELECT part, rn - 1 AS entry, p FROM sliced WHERE rn <= " + f"{entries})"
    steps = [book]

    def assigned(turn: int) -> str:
        return f"""
near{turn} AS MATERIALIZED (
  SELECT rn, part, first(p) AS p, min(far * 256 + entry) AS best
  FROM (SELECT s.rn, s.part, s.p, b.entry,
               list_sum(list_transform(list_zip(s.p, b.p), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::HUGEINT AS far
        FROM sliced s JOIN book{turn} b USING (part))
  GROUP BY rn, part)"""

    for turn in range(rounds):
        steps.append(assigned(turn))
        steps.append(f"""
sum{turn} AS MATERIALIZED (
  SELECT part, entry, list(mean ORDER BY place) AS p FROM (
    SELECT part, entry, place, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS mean
    FROM (SELECT part, best % 256 AS entry, unnest(p) AS x, generate_subscripts(p, 1) AS place FROM near{turn})
    GROUP BY part, entry, place)
  GROUP BY part, entry)""")
        steps.append(f"""
book{turn + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(s.p, b.p) AS p
  FROM book{turn} b LEFT JOIN sum{turn} s ON s.part = b.part AND s.entry = b.entry)""")
    steps.append(assigned(rounds))
    joined = ",".join(steps)
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS rn,
         list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
sliced AS MATERIALIZED (
  SELECT rn, part, v[part * (len(v) // {parts}) + 1 : (part + 1) * (len(v) // {parts})] AS p
  FROM kept, range({parts}) t(part)),
{joined},
coded AS (
  SELECT rn, string_agg(printf('%02x', (best % 256)::INT), '' ORDER BY part) AS code,
         sum(best // 256)::BIGINT AS error
  FROM near{rounds} GROUP BY rn),
digest AS (
  SELECT sha256(string_agg(array_to_string(p, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds})
SELECT k.vec_id, c.code, c.error, sum(c.error) OVER (PARTITION BY k.label)::BIGINT AS label_error, d.codebooks_sha256
FROM kept k JOIN coded c USING (rn), digest d
"""
