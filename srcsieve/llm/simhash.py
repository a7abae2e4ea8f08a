"""SimHash near-duplicates by pigeonhole blocks.

Two 64-bit fingerprints that differ in at most ``distance`` bits agree on all but ``distance``
of any ``blocks`` pieces they are cut into. So each distinct fingerprint is listed once under
every choice of ``blocks - distance`` pieces, fingerprints under the same key are joined, and the
join keeps those within the distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from srcsieve.llm.common import LOWER, texts, word_blocks
from srcsieve.operators.batches import slices
from srcsieve.operators.components import duplicate_components
from srcsieve.operators.joins import attach_group, drop_ids
from srcsieve.session import materialise

BITS = 64
SEED = 42
#: Blocks tried in turn. Fingerprints of a key with many members are listed anew under finer
#: blocks; the last level has two bits a block, so a key has 4 ** distance members at most.
LEVELS = (5, 8, 16, 32)
MAX_KEY_MEMBERS = 1024


def fingerprint(text: str, width: int = 3) -> int:
    """The SimHash of ``text``, as a signed 64-bit number.

    Words are runs without white space, A-Z lower-cased; shingles are ``width`` words joined by
    a space and count as often as they occur. A shorter text is one shingle; no word gives 0.
    """
    from xxhash import xxh64_intdigest

    ones, total, carried = np.zeros(BITS, dtype=np.int64), 0, []

    def add(shingles: list[bytes]) -> None:
        nonlocal total
        for at in range(0, len(shingles), 1 << 16):
            part = shingles[at : at + (1 << 16)]
            hashes = np.fromiter((xxh64_intdigest(s, SEED) for s in part), dtype="<u8", count=len(part))
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones.__iadd__(bits.sum(axis=0, dtype=np.int64))
            total += len(part)

    for block in word_blocks(text.encode("utf-8", "surrogatepass").translate(LOWER)):
        words = carried + block.split()
        add([b" ".join(s) for s in zip(*(words[i:] for i in range(width)))])
        carried = words[-(width - 1) :] if width > 1 else []
    if total == 0 and carried:
        add([b" ".join(carried)])
    packed = np.packbits(2 * ones > total, bitorder="little") if total else np.zeros(8, dtype=np.uint8)
    return int(packed.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """``(id_col, fingerprint)`` of every row, the fingerprint as a signed 64-bit number."""
    source = texts(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(text, width) for part in slices(batch.column(1)) for text in part]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints, type=pa.int64())], names=[batch.schema.field(0).name, "fingerprint"]
            )

    schema = T.StructType([source.schema[id_col], T.StructField("fingerprint", T.LongType())])
    return source.mapInArrow(run, schema)


def block_masks(blocks: int, distance: int) -> list[int]:
    """Signed 64-bit masks of every choice of ``blocks - distance`` of the blocks."""
    bounds = [BITS * i // blocks for i in range(blocks + 1)]
    pieces = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(bounds, bounds[1:])]
    masks = (sum(chosen) for chosen in combinations(pieces, blocks - distance))
    return [mask - (1 << BITS) if mask >> (BITS - 1) else mask for mask in masks]


def close_pairs(prints: DataFrame, distance: int = 2, max_members: int = MAX_KEY_MEMBERS) -> DataFrame:
    """``(a, b)`` with ``a < b`` for distinct fingerprints that differ in 1 to ``distance`` bits.

    ``prints`` has each ``fingerprint`` once. Keys with one member are left out before any join.
    The members of a key with over ``max_members`` are listed again under finer blocks instead of
    being paired there; each level finds all pairs it does not hand on.
    """
    found, left = None, prints.select("fingerprint")
    for blocks in LEVELS:
        masks = block_masks(blocks, distance)
        listed = F.array(*[
            F.struct(F.lit(i).alias("block"), F.col("fingerprint").bitwiseAND(F.lit(mask)).alias("key"))
            for i, mask in enumerate(masks)
        ])
        members = left.select("fingerprint", F.inline(listed))
        shared = members.groupBy("block", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
        last = blocks == LEVELS[-1]
        keyed = materialise(attach_group(members, shared, ["block", "key"], "n"), "block-members")
        small = keyed if last else keyed.where(F.col("n") <= max_members)
        a = small.select("block", "key", F.col("fingerprint").alias("a"))
        b = small.select("block", "key", F.col("fingerprint").alias("b"))
        pairs = (
            a.join(b, ["block", "key"])
            .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance))
            .select("a", "b")
        )
        found = pairs if found is None else found.unionByName(pairs)
        if last:
            break
        crowded = keyed.where(F.col("n") > max_members).select("fingerprint").distinct()
        if crowded.isEmpty():
            break
        left = materialise(crowded, "crowded")
    return found.distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 2, width: int = 3
) -> DataFrame:
    """``(id_col, fingerprint, component_id)`` of every row of ``docs``.

    ``component_id`` is the smallest id reachable over fingerprints at most ``distance`` bits
    apart. Copies share a fingerprint, so only distinct fingerprints are linked, and a group of
    copies of any size is one node. Null ids take part in links but name no component; a
    component of null ids only has a null one. Repeated rows each come back; other columns are
    dropped; an empty table gives an empty one.
    """
    prints = materialise(fingerprints(docs, id_col, text_col, width), "simhash")
    nodes = materialise(
        prints.groupBy("fingerprint").agg(F.min(id_col).alias("smallest"), F.count(F.lit(1)).alias("members")), "simhash-nodes"
    )
    edges = close_pairs(nodes, distance)
    roots = duplicate_components(edges, "b", "a").select(F.col("b").alias("fingerprint"), "root")
    rooted = nodes.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    names = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"), F.count(F.lit(1)).alias("nodes"))
    named = attach_group(rooted, names, ["root"], "nodes").select("fingerprint", "component_id", "members")
    return attach_group(prints, named, ["fingerprint"], "members").select(id_col, "fingerprint", "component_id")


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 2
) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id.

    Rows with a null id cannot be told apart and stay; rows that repeat an id are one document
    and stay or go together. All columns are kept.
    """
    gone = near_duplicates(docs, id_col, text_col, distance).where(F.col(id_col) != F.col("component_id"))
    return drop_ids(docs, gone.select(id_col).distinct(), id_col)
