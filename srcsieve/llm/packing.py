"""Best-fit packing by hierarchical residual rounds.

Each task tokenises its documents and packs their pieces best-fit, largest first. Bins that
are nearly full are done. The underfull bins of several tasks then meet, as items, in one
group of a merge tree and are packed best-fit again, until one group is left. A group is planned
from how many of its bins have each fill, and every bin finds its sequence by its number among
those of its fill, so no task holds the bins of a group. Only the ids and sizes of underfull bins move.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from srcsieve.llm.common import texts
from srcsieve.llm.word_ids import encoder
from srcsieve.session import materialise

CAPACITY = 2048
END_OF_DOCUMENT = 0
#: Pieces packed together in a task, so its memory does not follow the partition.
MAX_LOCAL_PIECES = 1 << 18
#: Texts whose ids a task holds at once.
ENCODED_TEXTS = 256
#: Parts in which the bins of one fill are numbered.
SALTS = 1024


def cut(n_ids: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of a document's pieces; only the first may be shorter than ``capacity``."""
    if n_ids <= capacity:
        return [(0, n_ids)]
    head = n_ids % capacity or capacity
    return [(0, head), *((at, capacity) for at in range(head, n_ids, capacity))]


def best_fit(sizes: Iterable[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Pack items largest first, each into the fullest bin that holds it.

    Returns the bin and the offset of each item, and the fill of each bin. Ties go to the
    item that comes first. Free bins are found by their room in a bit set.
    """
    sizes = np.asarray(sizes, dtype=np.int64)
    into, offset, fill = [0] * len(sizes), [0] * len(sizes), []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, at = capacity, len(fill)
            fill.append(0)
        into[item], offset[item] = at, capacity - room
        fill[at] += size
        by_room[room - size].append(at)
        rooms |= 1 << (room - size)
    return into, offset, fill


PIECES = {
    "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "ids": pa.binary(),
    "bin": pa.int64(), "offset": pa.int64(), "fill": pa.int64(), "part": pa.int32(),
}
PIECES_DDL = (
    "piece int, start long, length long, ids_crc32 long, ids binary, bin long, offset long, fill long, part int"
)


def _local_pieces(path: str, capacity: int, with_ids: bool):
    def encoded(ids: pa.Array, text: pa.Array) -> Iterator[tuple]:
        for at in range(0, len(text), ENCODED_TEXTS):
            yield from zip(ids.slice(at, ENCODED_TEXTS).to_pylist(), encoder(path).encode(text.slice(at, ENCODED_TEXTS)))

    def rows(ids: pa.Array, text: pa.Array) -> Iterator[tuple]:
        end = struct.pack("<I", END_OF_DOCUMENT)
        for doc, own in encoded(ids, text):
            data = own.tobytes() + end
            for piece, (start, length) in enumerate(cut(len(data) // 4, capacity)):
                part = data[4 * start : 4 * (start + length)]
                yield doc, piece, start, length, zlib.crc32(part), part if with_ids else None

    def packed(id_field: pa.Field, pieces: list[tuple], part: int, first: int) -> tuple[pa.RecordBatch, int]:
        into, offset, fill = best_fit([p[3] for p in pieces], capacity)
        columns = [list(c) for c in zip(*pieces)]
        columns += [[(part << 32) + first + b for b in into], offset, [fill[b] for b in into], [part] * len(pieces)]
        kinds = {id_field.name: id_field.type, **PIECES}
        arrays = [pa.array(c, type=kind) for c, kind in zip(columns, kinds.values())]
        return pa.RecordBatch.from_arrays(arrays, names=list(kinds)), first + len(fill)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, bins, pieces = TaskContext.get().partitionId(), 0, []
        field = None
        for batch in batches:
            field = batch.schema.field(0)
            for row in rows(batch.column(0), batch.column(1)):
                pieces.append(row)
                if len(pieces) == MAX_LOCAL_PIECES:
                    out, bins = packed(field, pieces, part, bins)
                    pieces = []
                    yield out
        if pieces:
            yield packed(field, pieces, part, bins)[0]

    return run


def plan_best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit of ``counts`` items per size, as ``(size, low, high, first, offset, filled)``.

    Items ``low`` to ``high`` (exclusive) of a size go one each to the sequences from ``first`` on, at
    ``offset``. ``filled`` is what those sequences hold in the end, given where ``offset`` is 0.
    Equal sequences are kept as ranges, so the work follows the sizes and not the items.
    """
    placed: list[list[int]] = []
    by_room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    rooms = opened = 0

    def put(room: int, first: int, count: int) -> None:
        nonlocal rooms
        if count:
            by_room[room].append((first, count))
            rooms |= 1 << room

    for size in sorted(counts, reverse=True):
        low, left = 0, counts[size]
        while left:
            fitting = rooms >> size
            if fitting:
                room = size + (fitting & -fitting).bit_length() - 1
                first, count = by_room[room].pop()
                if not by_room[room]:
                    rooms ^= 1 << room
            else:
                room, first, count = capacity, opened, -(-left // (capacity // size))
                opened += count
            each = room // size  # a sequence that still holds an item is the fullest that does
            whole = min(count, left // each)
            rest = left - whole * each if whole < count else 0
            for start, some, layers in ((first, whole, each), (first + whole, 1, rest)):
                for layer in range(layers if some else 0):
                    placed.append([size, low, low + some, start, capacity - room + layer * size])
                    low += some
            put(room - each * size, first, whole)
            if rest:
                put(room - rest * size, first + whole, 1)
            put(room, first + whole + (rest > 0), count - whole - (rest > 0))
            left = counts[size] - low
    ends = sorted((first, first + count, capacity - room) for room, own in enumerate(by_room) for first, count in own)
    starts, plan = [first for first, _, _ in ends], []
    for size, low, high, first, offset in placed:
        if offset:
            plan.append((size, low, high, first, offset, 0))
            continue
        at = bisect_right(starts, first) - 1
        while low < high:
            some = min(ends[at][1] - first, high - low)
            plan.append((size, low, low + some, first, 0, ends[at][2]))
            low, first, at = low + some, first + some, at + 1
    return plan


def _planner(capacity: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        plan = plan_best_fit(dict(zip(group["fill"].tolist(), group["n"].tolist())), capacity)
        found = pd.DataFrame(plan, columns=["fill", "low", "high", "first", "at", "filled"])
        return found.assign(part=group["part"].iloc[0])[["part", "fill", "low", "high", "first", "at", "filled"]]

    return run


def _merge(bins: DataFrame, capacity: int, turn: int) -> DataFrame:
    """``(bin, into, at, filled, part)``: where each of ``bin, fill, part`` goes. Merged bins have negative names."""
    salted = bins.withColumn("salt", F.pmod(F.xxhash64("bin"), F.lit(SALTS)))
    sizes = materialise(salted.groupBy("part", "fill", "salt").agg(F.count(F.lit(1)).alias("n")), "fills")
    before = F.sum("n").over(Window.partitionBy("part", "fill").orderBy("salt")) - F.col("n")
    plan = sizes.groupBy("part", "fill").agg(F.sum("n").alias("n")).groupBy("part").applyInPandas(
        _planner(capacity), "part int, fill long, low long, high long, first long, at long, filled long"
    )
    runs = plan.groupBy("part", "fill").agg(F.collect_list(F.struct("low", "high", "first", "at", "filled")).alias("runs"))
    # Each part of a fill gets the runs that its numbers fall into, so the join is as salted as the bins.
    shares = sizes.withColumn("before", before).join(runs, ["part", "fill"]).select(
        "part", "fill", "salt", "before",
        F.filter("runs", lambda r: (r["low"] < F.col("before") + F.col("n")) & (r["high"] > F.col("before"))).alias("runs"),
    )
    number = F.row_number().over(Window.partitionBy("part", "fill", "salt").orderBy("bin")) - 1
    numbered = salted.withColumn("number", number).join(shares, ["part", "fill", "salt"]).withColumn(
        "number", F.col("number") + F.col("before")
    )
    own = F.filter("runs", lambda r: (r["low"] <= F.col("number")) & (F.col("number") < r["high"]))[0]
    name = -((F.lit(turn).cast("long") * (1 << 56)) + F.col("part").cast("long") * (1 << 36)) - 1
    return numbered.withColumn("own", own).select(
        "bin", (name - (F.col("own.first") + F.col("number") - F.col("own.low"))).alias("into"),
        F.col("own.at").alias("at"), F.col("own.filled").alias("filled"), "part",
    )


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    slack: int = CAPACITY // 64,
    fan_in: int = 8,
    with_ids: bool = False,
) -> DataFrame:
    """Place every document in sequences of at most ``capacity`` tokens.

    One row per piece: ``id_col, piece, start, length, ids_crc32, sequence_id, offset`` and,
    ``with_ids``, the ids as little-endian 32-bit bytes. A document's ids end with id 0; only
    a document longer than ``capacity`` is cut, and only its first piece may be short. Bins
    filled to within ``slack`` are done; the others meet ``fan_in`` tasks at a time.

    A null or empty text is one token. A null id is carried like any other, repeated rows are
    packed one by one, other columns are dropped, and an empty table gives an empty one.
    """
    source = texts(docs, id_col, text_col)
    schema = T.StructType([source.schema[id_col], *T.StructType.fromDDL(PIECES_DDL)])
    pieces = materialise(source.mapInArrow(_local_pieces(tokenizer_path, capacity, with_ids), schema), "pieces")
    nearly_full = capacity - slack
    bins = pieces.where((F.col("offset") == 0) & (F.col("fill") < nearly_full)).select("bin", "fill", "part")
    moved = materialise(bins.select("bin", F.col("bin").alias("into"), F.lit(0).cast("long").alias("at")), "moved")
    parts = (bins.agg(F.max("part")).first()[0] or 0) + 1
    turn = 0
    while parts > 1:
        parts = -(-parts // fan_in)
        turn += 1
        merged = _merge(bins.withColumn("part", (F.col("part") / fan_in).cast("int")), capacity, turn)
        merged = materialise(merged, "merged")
        step = merged.select(F.col("bin").alias("into"), F.col("into").alias("_into"), F.col("at").alias("_at"))
        moved = materialise(
            moved.join(step, "into", "left").select(
                "bin",
                F.coalesce("_into", "into").alias("into"),
                (F.col("at") + F.coalesce("_at", F.lit(0))).alias("at"),
            ),
            "moved",
        )
        bins = merged.where((F.col("at") == 0) & (F.col("filled") < nearly_full)).select(F.col("into").alias("bin"), F.col("filled").alias("fill"), "part")
    placed = pieces.join(moved, "bin", "left")
    return placed.select(
        id_col, "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []),
        F.coalesce("into", "bin").alias("sequence_id"),
        (F.col("offset") + F.coalesce("at", F.lit(0))).alias("offset"),
    )
