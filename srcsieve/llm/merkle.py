"""Merkle manifest of a corpus: one tree per group, one tree over the groups' roots.

The leaves of a group are numbered in order without a task that holds the group. A level is a
window over dense positions: the nodes of level ``l`` sit on every ``fan_out ** l``-th row, so a
node's siblings are lag and lead columns of fixed offsets, masked by its slot and by the length of
its run, and the first child of a run hashes the parent. Windows are cut where no run crosses, so
a partition holds ``fan_out ** LEVELS`` rows however large the group is; the roots of these chunks are
the leaves of the next pass. All of it is DataFrame code on digests: texts are hashed where they are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from srcsieve.operators.joins import global_row_number, lookup_join
from srcsieve.session import materialise

FAN_OUT = 3
#: Levels of a pass: windows of 3 ** 5 rows.
LEVELS = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of ``parts``, concatenated."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def framed(value: Column) -> Column:
    """``value`` as text with its length before it, so that no two rows read the same; ``-`` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*fields: Column) -> Column:
    """The leaf of a row with these fields."""
    return digest(*[framed(field) for field in fields])


def fold(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` and the siblings of its ``proof`` give."""
    return F.aggregate(proof, leaf, lambda node, step: digest(step["before"], node, step["after"]))


def proof_hash(proof: Column) -> Column:
    """The digest of all siblings of a ``proof``, level by level, left to right."""
    return digest(F.array_join(F.transform(proof, lambda step: F.concat(step["before"], step["after"])), ""))


def _positions(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` with their place ``_pos`` in ``_group`` from 0 on and the group's size ``_n``.

    Ranges over all groups are counted per group and shifted by the ranges before them. Rows that
    are equal in every key are dealt out by a running number, so copies of one row fill no range alone.
    """
    n = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tied = leaves.withColumn("_tie", F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(n, "_group", *order, "_tie").withColumn("_range", F.spark_partition_id())
    ranged = materialise(ranged, "leaf-ranges")
    group = Window.partitionBy("_group")
    before = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("_range", "_group").agg(F.count(F.lit(1)).alias("_rows")).select(
        "_range", "_group",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(group).alias("_n"),
    )
    within = Window.partitionBy("_range", "_group").orderBy(*order, "_tie")
    numbered = ranged.join(sizes, ["_range", "_group"]).withColumn(
        "_pos", F.col("_before") + F.row_number().over(within) - 1
    )
    return materialise(numbered.drop("_range", "_before", "_tie"), "leaves")


def _over(dividend: Column, divisor: int) -> Column:
    """Whole-number quotient, rounded up."""
    return F.floor((dividend + (divisor - 1)) / divisor)


def _climb(nodes: DataFrame, fan_out: int, levels: int) -> DataFrame:
    """``levels`` levels above ``nodes``: adds ``_chunk``, the siblings met (``_proof``) and the node reached (``_top``).

    Groups that are down to one node stay as they are.
    """
    chunked = nodes.withColumn("_chunk", F.floor(F.col("_pos") / fan_out**levels))
    window = Window.partitionBy("_group", "_chunk").orderBy("_pos")
    so_far = window.rowsBetween(Window.unboundedPreceding, 0)
    offsets = range(1, fan_out)
    rows, node = chunked.withColumn("_node0", F.col("_hash")), "_node0"
    for level in range(levels):
        width = fan_out**level
        left, place = _over(F.col("_n"), width), F.floor(F.col("_pos") / width)
        slot = place % fan_out
        run = F.least(F.lit(fan_out).cast("long"), left - (place - slot))
        rows = rows.withColumns(
            {f"_lag{o}": F.lag(node, o * width).over(window) for o in offsets}
            | {f"_lead{o}": F.lead(node, o * width).over(window) for o in offsets}
        )
        before = F.concat(*[F.when(slot >= o, F.col(f"_lag{o}")).otherwise("") for o in reversed(offsets)])
        after = F.concat(*[F.when(slot + o < run, F.col(f"_lead{o}")).otherwise("") for o in offsets])
        own = (F.col("_pos") % width == 0) & (left > 1)  # the row that the node sits on
        rows = rows.withColumn("_step", F.when(own, F.struct(before.alias("before"), after.alias("after"))))
        parent = F.when(left > 1, digest(F.col(node), F.col("_step.after"))).otherwise(F.col(node))
        rows = rows.withColumns({
            f"_step{level}": F.last("_step", ignorenulls=True).over(so_far),
            f"_node{level + 1}": F.when(F.col("_pos") % (width * fan_out) == 0, parent),
        })
        node = f"_node{level + 1}"
    proof = F.array_compact(F.array(*[f"_step{level}" for level in range(levels)]))
    return rows.select(*chunked.columns, proof.alias("_proof"), F.first(node).over(so_far).alias("_top"))


def _chunk_tops(climbed: DataFrame, fan_out: int, levels: int) -> DataFrame:
    """The node that each chunk came to, as a leaf of the next pass."""
    first = climbed.where(F.col("_pos") % fan_out**levels == 0)
    return first.select(
        "_group", F.col("_chunk").alias("_pos"), _over(F.col("_n"), fan_out**levels).alias("_n"),
        F.col("_top").alias("_hash"),
    )


def _tree(nodes: DataFrame, fan_out: int, levels: int) -> DataFrame:
    """``nodes`` with the siblings up to the root of their group (``_proof``) and that root (``_root``).

    Each pass has ``fan_out ** levels`` times fewer rows, so their number follows the logarithm
    of the largest group.
    """
    climbed = _climb(nodes, fan_out, levels)
    largest = nodes.agg(F.max("_n")).first()[0] or 0
    if largest <= fan_out**levels:
        return climbed.drop("_chunk").withColumnRenamed("_top", "_root")
    chunks = materialise(_chunk_tops(climbed, fan_out, levels), "chunk-tops")
    above = _tree(chunks, fan_out, levels).select(
        "_group", F.col("_pos").alias("_chunk"), F.col("_proof").alias("_above"), "_root"
    )
    joined = climbed.drop("_top").join(above, ["_group", "_chunk"])
    return joined.withColumn("_proof", F.concat("_proof", "_above")).drop("_chunk", "_above")


def merkle_manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    id_col: str = "doc_id",
    group_col: str = "source",
    also: Column | None = None,
    fan_out: int = FAN_OUT,
    levels: int = LEVELS,
) -> DataFrame:
    """``(id_col, leaf, proof, subroot, root)`` of every row, and ``also``, a column over ``docs``, if given.

    ``proof`` lists, level by level up to ``root``, the digests ``before`` and ``after`` a row's own
    node in its run; ``fold`` recomputes the root from it. Leaves ascend by id within their group, groups by
    their name as UTF-8 bytes.

    Null ids come first in their group and a null group before all others; null fields are framed as ``-``.
    Equal ids are ordered by their leaves, and repeated rows are leaves of their own. Empty and very
    long texts are hashed like any other, other columns are not read, and an empty table gives an empty one.
    """
    group = F.coalesce(F.concat(F.lit("="), docs[group_col].cast("string")), F.lit(""))
    leaves = docs.select(
        docs[id_col].alias("_id"), group.alias("_group"), leaf_hash(*[docs[f] for f in fields]).alias("_hash"),
        *([also.alias("_also")] if also is not None else []),
    )
    numbered = _positions(leaves, ["_id", "_hash"])
    climbed = _climb(numbered, fan_out, levels)
    chunks = materialise(_chunk_tops(climbed, fan_out, levels), "chunk-tops")
    subtrees = materialise(_tree(chunks, fan_out, levels), "subtrees").withColumnRenamed("_root", "_subroot")
    roots = subtrees.where(F.col("_pos") == 0).select(F.col("_group").alias("_name"), F.col("_subroot").alias("_hash"))
    roots = materialise(global_row_number(roots, ["_name"], "_pos").withColumn("_pos", F.col("_pos") - 1), "subroots")
    forest = roots.withColumn("_group", F.lit("")).withColumn("_n", F.lit(roots.count()).cast("long"))
    top = _tree(forest, fan_out, levels).select(F.col("_name").alias("_group"), F.col("_proof").alias("_above"), "_root")
    above = lookup_join(subtrees.drop("_hash", "_n"), top, ["_group"]).select(
        "_group", F.col("_pos").alias("_chunk"), F.concat("_proof", "_above").alias("_above"), "_subroot", "_root"
    )
    return climbed.join(above, ["_group", "_chunk"]).select(
        F.col("_id").alias(id_col), F.col("_hash").alias("leaf"), F.concat("_proof", "_above").alias("proof"),
        F.col("_subroot").alias("subroot"), F.col("_root").alias("root"),
        *([F.col("_also").alias("also")] if also is not None else []),
    )


def audit(
    docs: DataFrame,
    suspect: Column,
    changed_text: Column,
    fields: tuple[str, ...] = FIELDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    **options,
) -> DataFrame:
    """The manifest of ``docs``, checked against rows whose text is ``changed_text`` where ``suspect`` holds.

    ``(id_col, leaf, subroot, root, proof_sha256, folded_root, verified)``: ``folded_root`` comes from the
    leaf as it is now and the siblings as they were, and ``verified`` says that it still is the root.
    A null ``suspect`` counts as false, and a null text stays null. Rows are treated as in ``merkle_manifest``.
    """
    now = leaf_hash(*[changed_text if field == text_col else docs[field] for field in fields])
    found = merkle_manifest(docs, fields, id_col, also=F.when(suspect, now), **options)
    folded = found.withColumn("folded_root", fold(F.coalesce("also", "leaf"), F.col("proof")))
    return folded.select(
        id_col, "leaf", "subroot", "root", proof_hash(F.col("proof")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def oracle_sql() -> str:
    """DuckDB SQL of ``audit`` over ``documents``, newlines deleted where crc32 of the id is even."""
    framed_sql = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join(framed_sql(c) for c in (*FIELDS[:-1], text)) + ")"
    bit = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: unicode(d)::BIGINT)"
    crc = f"xor(list_reduce([4294967295::BIGINT] || {codes}, lambda c, b: {bit}), 4294967295)"

    def up(source: str) -> str:
        return f"""
  SELECT 0 AS level, grp, pos, n, h FROM {source}
  UNION ALL
  SELECT level + 1, grp, pos // {FAN_OUT}, (n + {FAN_OUT - 1}) // {FAN_OUT}, sha256(string_agg(h, '' ORDER BY pos))
  FROM {source}_up WHERE n > 1 GROUP BY level, grp, pos // {FAN_OUT}, n"""

    def steps(source: str) -> str:
        own = f"d.pos // CAST(pow({FAN_OUT}, s.level) AS BIGINT)"
        side = lambda sign: f"coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos {sign} {own}), '')"
        return f"""
  SELECT d.rid, s.level, {side("<")} AS before, {side(">")} AS after
  FROM {source} d JOIN {source}_up s ON s.grp = d.grp AND s.n > 1 AND s.pos // {FAN_OUT} = ({own}) // {FAN_OUT}
  GROUP BY d.rid, s.level"""

    return f"""
WITH RECURSIVE
hashed AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || source, '') AS grp, {leaf("text")} AS h,
         CASE WHEN {crc} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} END AS now
  FROM documents),
leaves AS MATERIALIZED (
  SELECT *, row_number() OVER () AS rid, count(*) OVER (PARTITION BY grp) AS n,
         row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS pos
  FROM hashed),
leaves_up AS ({up("leaves")}),
groups AS MATERIALIZED (
  SELECT grp AS name, '' AS grp, h, count(*) OVER () AS n, row_number() OVER (ORDER BY grp) - 1 AS pos,
         row_number() OVER (ORDER BY grp) AS rid
  FROM leaves_up WHERE n = 1),
groups_up AS ({up("groups")}),
lower_steps AS ({steps("leaves")}),
upper_steps AS ({steps("groups")}),
steps AS (
  SELECT rid, 0 AS tree, level, before, after FROM lower_steps
  UNION ALL
  SELECT l.rid, 1, u.level, u.before, u.after
  FROM leaves l JOIN groups g ON g.name = l.grp JOIN upper_steps u ON u.rid = g.rid),
proofs AS (
  SELECT rid, string_agg(before || after, '' ORDER BY tree, level) AS siblings,
         list(before || '|' || after ORDER BY tree, level) AS path
  FROM steps GROUP BY rid),
folded AS (
  SELECT l.*, g.h AS subroot, r.h AS root, sha256(coalesce(p.siblings, '')) AS proof_sha256,
         list_reduce([coalesce(l.now, l.h)] || coalesce(p.path, []),
                     lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2))) AS folded_root
  FROM leaves l JOIN groups g ON g.name = l.grp JOIN groups_up r ON r.n = 1 LEFT JOIN proofs p ON p.rid = l.rid)
SELECT doc_id, h AS leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""
