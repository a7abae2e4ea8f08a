"""Removal of byte strings that occur more than once, by suffix order.

Every string of ``length`` bytes has an anchor: of the short grams in it, the one with the smallest
hash. Equal strings have equal anchors, so strings are brought together by anchor: runs of
strings with one anchor are one segment of text, and only segments whose anchor occurs again go on.
Equal segments are counted before they move. The distinct ones are dealt into shards by anchor, and a
shard is sorted by external induced sorting; a suffix that shares ``length`` bytes with a
neighbour in that order, or stands in a segment that occurs again, starts a repeated string.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from srcsieve.llm.common import texts
from srcsieve.llm.induced_sort import Scratch, sorted_suffixes
from srcsieve.operators.joins import attach_group
from srcsieve.session import materialise

LENGTH = 200
GRAM = 24
BUFFER = 1 << 20  # bytes hashed at a time; a gram's place in it takes 20 bits
#: An anchor with more distinct segments is split by where in a string the anchor stands, and by
#: the bytes that all strings of such a part share.
MAX_SEGMENTS = 4096
SPLIT = 8
SHARDS_PER_PARTITION = 3
#: Bytes of segments per shard at most, on average; ``induced_sort`` holds texts of twice that in memory.
SHARD_BYTES = 2 << 20
_MIX = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes at each place."""
    count = len(data) - gram + 1
    mixed = np.zeros(count, dtype=np.uint64)
    step = 8 if gram >= 8 else 1
    places = [*range(0, gram - step + 1, step)]
    if places[-1] != gram - step:
        places.append(gram - step)
    words = np.ndarray((len(data) - step + 1,), "<u8" if step == 8 else "u1", buffer=data.data, strides=(1,))
    for i, at in enumerate(places):
        mixed += words[at : at + count].astype(np.uint64) * (_MIX[i % 3] + np.uint64(2 * i))
        mixed ^= mixed >> np.uint64(29)
    mixed *= _MIX[3]
    mixed ^= mixed >> np.uint64(32)
    return mixed


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` values in a row."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[: len(values)] = values
    rows = padded.reshape(-1, width)
    to_end = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    from_start = np.minimum.accumulate(rows, axis=1).ravel()
    return np.minimum(to_end[:count], from_start[width - 1 : width - 1 + count])


def segments(data: bytes, ends: list[int], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """``(begin, end, gram place, anchor)`` of each run of strings with one anchor.

    ``data`` holds several texts, which end at ``ends``; a string lies in one of them.
    """
    empty = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return empty, empty, empty, empty.astype(np.uint64)
    hashes = gram_hashes(np.frombuffer(data, dtype=np.uint8), gram)
    low = np.uint64(BUFFER - 1)
    place = np.arange(len(hashes), dtype=np.uint64)
    least = sliding_min((hashes & ~low) | place, length - gram + 1) & low
    begins = np.array([0, *ends[:-1]], dtype=np.int64)
    inside = np.zeros(len(data) + 1, dtype=np.int32)
    room = np.maximum(np.array(ends) - begins - length + 1, 0)
    np.add.at(inside, begins, (room > 0).astype(np.int32))
    np.add.at(inside, begins + room, -(room > 0).astype(np.int32))
    at = np.flatnonzero(np.cumsum(inside)[: len(least)])
    if not len(at):
        return empty, empty, empty, empty.astype(np.uint64)
    anchor = least[at]
    breaks = np.append(True, (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1))
    first = np.flatnonzero(breaks)
    last = np.append(first[1:], len(at)) - 1
    chosen = anchor[first].astype(np.int64)
    return at[first], at[last] + length, chosen, hashes[chosen]


def _buffers(whole: list[str], length: int) -> Iterator[tuple[bytes, list[int], list[tuple[int, int]]]]:
    """Texts joined to buffers: the bytes, where each piece ends, and its ``(text, offset)``.

    A long text is cut into pieces that overlap by ``length - 1`` bytes, so each string is in one.
    """
    parts, ends, owners, size = [], [], [], 0
    for i, text in enumerate(whole):
        data = text.encode("utf-8", "surrogatepass")
        if len(data) < length:
            continue
        step = BUFFER // 2
        for at in range(0, max(len(data) - length + 1, 1), step):
            piece = data[at : at + step + length - 1]
            if size + len(piece) > BUFFER:
                yield b"".join(parts), ends, owners
                parts, ends, owners, size = [], [], [], 0
            size += len(piece)
            parts.append(piece)
            ends.append(size)
            owners.append((i, at))
    if parts:
        yield b"".join(parts), ends, owners


def _lister(length: int, gram: int):
    from xxhash import xxh64_intdigest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, ends, owners in _buffers(batch.column(2).to_pylist(), length):
                begin, end, place, anchor = segments(data, ends, length, gram)
                anchors = pa.array(anchor.view(np.int64))
                piece = np.searchsorted(np.array(ends), begin, "right")
                text = np.array([t for t, _ in owners], dtype=np.int64)[piece]
                offset = np.array([o for _, o in owners], dtype=np.int64)[piece] - np.array([0, *ends[:-1]], dtype=np.int64)[piece]
                spans = zip(begin.tolist(), end.tolist())
                digest = np.fromiter((xxh64_intdigest(data[a:b]) for a, b in spans), dtype=np.uint64, count=len(begin))
                at = ((begin + offset) << 24) | ((end - begin) << 12) | (place - begin)
                rows = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), anchors,
                     pa.array(digest.view(np.int64)), pa.array(at)],
                    names=[batch.schema.field(0).name, "own", "anchor", "digest", "at"],
                )

    return run


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the asked segments of each text."""
    for batch in batches:
        out = {"anchor": [], "digest": [], "copies": [], "place": [], "bytes": []}
        for text, asked in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            data = text.encode("utf-8", "surrogatepass")
            for one in asked:
                begin, size = one["at"] >> 24, (one["at"] >> 12) & 0xFFF
                out["anchor"].append(one["anchor"])
                out["digest"].append(one["digest"])
                out["copies"].append(one["copies"])
                out["place"].append(one["at"] & 0xFFF)
                out["bytes"].append(data[begin : begin + size])
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(v, type=k) for v, k in zip(out.values(), kinds)], names=list(out))


def _splitter(length: int):
    """Parts of a segment by how far its strings begin before the anchor; ``shard`` hashes what each part shares."""
    from xxhash import xxh64_intdigest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, shards, shifts, parts = [], [], [], []
            for i, (anchor, place, data) in enumerate(
                zip(batch.column("anchor").to_pylist(), batch.column("place").to_pylist(), batch.column("bytes").to_pylist())
            ):
                step = -(-length // SPLIT)
                for near in range(0, length, step):  # strings that begin near .. near + step - 1 before the anchor
                    begin, end = max(place - near - step + 1, 0), min(place - near, len(data) - length)
                    if begin > end:
                        continue
                    # Bytes in every string of the part, whatever segment it lies in.
                    shared = data[place - near : place - near - step + 1 + length]
                    shards.append(xxh64_intdigest(b"%d:%d:" % (anchor, near) + shared) - (1 << 63))
                    rows.append(i)
                    shifts.append(begin)
                    parts.append(data[begin : end + length])
            taken = pa.array(rows, type=pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(shards, type=pa.int64()), pa.array(shifts, type=pa.int32()),
                 *(batch.column(c).take(taken) for c in ("anchor", "digest", "copies")), pa.array(parts, type=pa.binary())],
                names=["shard", "shift", "anchor", "digest", "copies", "bytes"],
            )

    return run


#: Bytes of texts moved up by two: 0 ends the sorted text, 1 ends a piece. UTF-8 has no byte above 0xF7.
_UP = bytes((b + 2) % 256 for b in range(256))


def repeated_starts(
    text: np.ndarray, starts: np.ndarray, sizes: np.ndarray, copies: np.ndarray, length: int, scratch: Scratch
) -> tuple[np.ndarray, np.ndarray]:
    """``(piece, start)`` of every string of ``length`` bytes that occurs again, by suffix order.

    ``text`` holds the pieces, each moved up and ended; all strings of a piece with copies repeat.
    """
    marked = scratch.zeros(len(text), np.bool_)
    previous = -1
    for suffixes, shared in sorted_suffixes(text, length, scratch):
        alike = shared >= length
        marked[suffixes[alike]] = True
        marked[suffixes[:-1][alike[1:]]] = True
        if alike[0]:
            marked[previous] = True
        previous = int(suffixes[-1])
    for i in np.flatnonzero(copies > 1).tolist():
        marked[starts[i] : starts[i] + sizes[i]] = True
    found = np.flatnonzero(marked)
    piece = np.searchsorted(starts, found, "right") - 1
    own = found - starts[piece]
    whole = own + length <= sizes[piece]
    return piece[whole], own[whole]


def _sorter(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("anchor", "digest", "copies", "shift")
        with Scratch() as scratch:
            kept, sizes, path = {name: [] for name in names}, [], scratch.path()
            with open(path, "wb") as out:
                for batch in batches:
                    for name in names:
                        kept[name].append(batch.column(name).to_numpy(zero_copy_only=False))
                    for piece in batch.column("bytes"):
                        data = piece.as_py()
                        sizes.append(len(data))
                        out.write(data.translate(_UP) + b"\x01")
                out.write(b"\x00")
            if not sizes:
                return
            small = os.path.getsize(path) <= scratch.memory_limit
            text = np.fromfile(path, np.uint8) if small else np.memmap(path, np.uint8, "r")
            columns = {name: np.concatenate(parts) for name, parts in kept.items()}
            sizes = np.array(sizes, dtype=np.int64)
            starts = np.cumsum(np.append(0, sizes[:-1] + 1))
            piece, start = repeated_starts(text, starts, sizes, columns["copies"], length, scratch)
        if not len(piece):
            return
        first = np.flatnonzero(np.append(True, (piece[1:] != piece[:-1]) | (start[1:] != start[:-1] + 1)))
        last = np.append(first[1:], len(piece)) - 1
        owner, counts = np.unique(piece[first], return_counts=True)
        begin = (start[first] + columns["shift"][piece[first]]).astype(np.int32)
        end = (start[last] + length + columns["shift"][piece[last]]).astype(np.int32)
        spans = pa.ListArray.from_arrays(
            pa.array(np.append(0, np.cumsum(counts)), type=pa.int32()),
            pa.StructArray.from_arrays([pa.array(begin), pa.array(end)], names=["begin", "end"]),
        )
        for at in range(0, len(owner), 10_000):
            rows = owner[at : at + 10_000]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(columns[name][rows]) for name in names[:3]), spans[at : at + 10_000]],
                names=["anchor", "digest", "copies", "spans"],
            )

    return run


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM
) -> DataFrame:
    """``(id_col, own, spans)``: for each document with repeated strings, the byte runs they cover.

    ``own`` is a hash of the text, which tells texts under one id apart. ``spans`` may overlap.
    """
    source = texts(docs, id_col, text_col).select(id_col, F.xxhash64("text").alias("own"), "text")
    id_field = source.schema[id_col]
    listed = T.StructType([id_field, *T.StructType.fromDDL("own long, anchor long, digest long, at long")])
    # Written, as hashing every gram a second time costs more than reading the segments again.
    spelled = materialise(source.mapInArrow(_lister(length, gram), listed), "listed-segments")
    again = spelled.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    met = materialise(attach_group(spelled, again, ["anchor"], "n").drop("n"), "segments")

    kinds = met.groupBy("anchor", "digest").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct(id_col, "own", "at")).alias("one")
    )
    kinds = materialise(kinds, "segment-kinds")
    # All strings of a segment with copies repeat. Where every segment of an anchor has copies, nothing is left to sort.
    anchors = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("copies").alias("least"))
    anchors = materialise(anchors, "anchors")
    copied = materialise(attach_group(kinds.where(F.col("copies") > 1), anchors, ["anchor"], "n").drop("n"), "copied-kinds")
    settled = copied.where(F.col("least") > 1)
    unsorted = kinds.where(F.col("copies") == 1).unionByName(copied.where(F.col("least") == 1).drop("least"))
    size = F.shiftright("one.at", 12).bitwiseAND(0xFFF)
    asked = unsorted.groupBy(F.col(f"one.{id_col}").alias("_id"), F.col("one.own").alias("_own")).agg(
        F.collect_list(F.struct("anchor", "digest", "copies", F.col("one.at").alias("at"))).alias("asked")
    )
    cut = (
        source.join(asked, source[id_col].eqNullSafe(asked["_id"]) & (source["own"] == asked["_own"]))
        .select("text", "asked")
        .mapInArrow(_cutter, "anchor long, digest long, copies long, place int, bytes binary")
    )
    crowded = anchors.where((F.col("n") > MAX_SEGMENTS) & (F.col("least") == 1)).select("anchor")
    crowded = materialise(crowded, "crowded-anchors")
    plain = F.col("anchor").alias("shard"), F.lit(0).alias("shift"), "anchor", "digest", "copies", "bytes"
    if crowded.isEmpty():
        parts = cut.select(*plain)
    else:
        cut = materialise(cut, "segment-bytes")
        split = cut.join(crowded, "anchor", "left_semi").mapInArrow(
            _splitter(length), "shard long, shift int, anchor long, digest long, copies long, bytes binary"
        )
        parts = cut.join(crowded, "anchor", "left_anti").select(*plain).unionByName(split)
    # A sort takes some forty times the bytes of its shard: three shards for each partition of a plain shuffle, more for many bytes.
    to_sort = unsorted.agg(F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()[0]
    shards = max(SHARDS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-to_sort // SHARD_BYTES))
    found = parts.repartition(shards, "shard").mapInArrow(
        _sorter(length), "anchor long, digest long, copies long, spans array<struct<begin:int,end:int>>"
    )
    covered = found.groupBy("anchor", "digest").agg(
        F.max("copies").alias("copies"), F.flatten(F.collect_list("spans")).alias("spans")
    )
    whole = F.array(F.struct(F.lit(0).alias("begin"), size.cast("int").alias("end")))
    covered = covered.unionByName(settled.select("anchor", "digest", "copies", whole.alias("spans")))
    begin = F.shiftright("at", 24)
    moved = F.transform("spans", lambda s: F.struct((begin + s["begin"]).alias("begin"), (begin + s["end"]).alias("end")))
    hits = attach_group(met, covered, ["anchor", "digest"], "copies").select(id_col, "own", moved.alias("spans"))
    return hits.groupBy(id_col, "own").agg(F.sort_array(F.flatten(F.collect_set("spans"))).alias("spans"))


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs covered by sorted spans; runs that touch are one."""
    runs: list[tuple[int, int]] = []
    for span in spans:
        begin, end = span["begin"], span["end"]
        if runs and begin <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], end))
        else:
            runs.append((begin, end))
    return runs


def _remover(with_kept: bool):
    return lambda batches: _removed(batches, with_kept)


def _removed(batches: Iterator[pa.RecordBatch], with_kept: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, sizes, removed, counts = [], [], [], []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            data = text.encode("utf-8", "surrogatepass")
            runs = merged(spans or [])
            edges = [0, *(e for run in runs for e in run), len(data)]
            kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
            sizes.append(len(data))
            removed.append(len(data) - len(kept[-1]))
            counts.append(len(runs))
        columns = [pa.array(c, type=pa.int64()) for c in (sizes, removed, counts)]
        hashes = pa.array([hashlib.sha256(k).hexdigest() for k in kept], type=pa.string())
        rest = pa.array(kept if with_kept else [None] * len(kept), type=pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *columns, hashes, rest],
            names=[batch.schema.field(0).name, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    with_kept: bool = True,
) -> DataFrame:
    """``(id_col, n_bytes, n_removed, n_spans, kept_sha256, kept)`` of every row of ``docs``.

    Each byte covered by a string of ``length`` bytes that also starts anywhere else goes, the
    first occurrence too; ``kept`` is the rest, as bytes, since a run may end inside a character.
    ``length`` is under 2,048. Null texts are empty. Repeated rows count as separate texts and each come back, null ids
    too; other columns are dropped.
    """
    spans = repeated_spans(docs, id_col, text_col, length, gram)
    spans = spans.select(F.col(id_col).alias("_id"), F.col("own").alias("_own"), "spans")
    source = texts(docs, id_col, text_col).withColumn("own", F.xxhash64("text"))
    joined = source.join(
        spans, source[id_col].eqNullSafe(spans["_id"]) & (F.col("own") == F.col("_own")), "left"
    ).select(id_col, "text", "spans")
    rest = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    schema = T.StructType([source.schema[id_col], *T.StructType.fromDDL(rest)])
    removed = joined.mapInArrow(_remover(with_kept), schema)
    return removed if with_kept else removed.drop("kept")
