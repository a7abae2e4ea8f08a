"""Line deduplication over overlapping windows of three lines.

Windows are compared over the whole corpus by a 128-bit hash. The first occurrence of a window,
by document and position, stays; the lines of every later occurrence go, overlapping windows
merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from srcsieve.llm.text_stats import bound
from srcsieve.operators.joins import attach_group, lookup_join

WINDOW = 3
_WORD = r"[^\x20\x09-\x0D]"


def _lines(text: Column) -> Column:
    """Lines with a word, each with its place among all lines, from 0."""
    numbered = F.transform(F.split(text, "\n", -1), lambda line, i: F.struct(i.alias("at"), line.alias("line")))
    return F.filter(numbered, lambda e: e["line"].rlike(_WORD))


def _windows(lines: Column, window: int) -> Column:
    """``(at, h1, h2)`` of each window, ``at`` its first line among the lines with a word.

    The two hashes read the lines in a different order, so together they are 128 bits.
    """
    starts = F.when(F.size(lines) >= window, F.sequence(F.lit(0), F.size(lines) - window)).otherwise(
        F.array().cast("array<int>")
    )

    def one(i: Column) -> Column:
        parts = [F.get(lines, i + k)["line"] for k in range(window)]
        return F.struct(
            i.alias("at"), F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(window), *parts[::-1]).alias("h2")
        )

    return F.transform(starts, one)


def line_windows(docs: DataFrame, id_col: str, text_col: str, window: int = WINDOW) -> DataFrame:
    """``(id_col, own, at, h1, h2)``, a row per window; ``own`` tells texts under one id apart."""
    text = F.coalesce(docs[text_col], F.lit(""))
    lines = docs.select(docs[id_col].alias(id_col), F.xxhash64(text).alias("own"), _lines(text).alias("lines"))
    return lines.select(id_col, "own", F.inline(bound(F.col("lines"), lambda n: _windows(n, window))))


def later_windows(windows: DataFrame, id_col: str) -> DataFrame:
    """Windows that are not the first occurrence of their three lines.

    Occurrences are counted before the shuffle; only windows that occur again are looked at
    one by one.
    """
    order = F.struct(F.col(id_col), F.col("own"), F.col("at"))
    first = (
        windows.groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
        .where(F.col("n") > 1)
    )
    met = attach_group(windows, first, ["h1", "h2"], "n").drop("n")
    return met.where(~F.struct(F.col(id_col), F.col("own"), F.col("at")).eqNullSafe(F.col("first")))


def _covered(starts: Column, window: int) -> Column:
    """Line numbers covered by windows at ``starts``."""
    return F.array_distinct(F.flatten(F.transform(starts, lambda s: F.sequence(s, s + (window - 1)))))


def repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """``(id_col, own, starts)``: the sorted starts of later windows of each document that has any."""
    later = later_windows(line_windows(docs, id_col, text_col, window), id_col)
    return later.groupBy(id_col, "own").agg(F.sort_array(F.collect_set("at")).alias("starts"))


def _of_document(id_column: Column, own: Column) -> Column:
    """16 bytes for an id, null or not, and the hash of its text."""
    named = F.concat_ws(":", own.cast("string"), F.when(id_column.isNull(), "-").otherwise("+"), id_column.cast("string"))
    return F.unhex(F.md5(named.cast("binary")))


def _cut(docs: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """``(_row, _kept, _n_lines, _n_removed)``: each row as it was given, the text kept, and the counts."""
    spans = repeated_lines(docs, id_col, text_col, window)
    spans = spans.select(_of_document(F.col(id_col), F.col("own")).alias("_of"), F.col("starts").alias("_starts"))
    text, row = F.col("_row")[text_col], F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row")
    own = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    joined = lookup_join(docs.select(row, _of_document(docs[id_col], own).alias("_of")), spans, ["_of"], "left")
    lines = F.when(F.col("_starts").isNotNull(), F.split(text, "\n", -1))
    with_word = bound(lines, lambda all_lines: F.filter(
        F.sequence(F.lit(0), F.size(all_lines) - 1), lambda i: F.get(all_lines, i).rlike(_WORD)
    ))
    staged = joined.withColumns({"_lines": lines, "_with_word": with_word})
    gone = F.transform(_covered(F.col("_starts"), window), lambda i: F.get(F.col("_with_word"), i))
    staged = staged.withColumn("_gone", gone)
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    kept = F.transform(stay, lambda i: F.get(F.col("_lines"), i))
    n_lines = F.size(F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda line: line.rlike(_WORD)))
    return staged.select(
        "_row",
        F.when(F.col("_starts").isNull(), text).otherwise(F.array_join(kept, "\n")).alias("_kept"),
        n_lines.alias("_n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).alias("_n_removed"),
    )


def _given(columns: list[str], text_col: str) -> list[Column]:
    return [(F.col("_kept") if c == text_col else F.col("_row")[c]).alias(c) for c in columns]


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """``docs``, all columns kept, with repeated lines removed from the text.

    Adds ``_n_lines`` (lines with a word) and ``_n_removed``, in place of given columns of these names. Only
    windows of lines with a word count, and only such lines go; the others stay where they are. The first occurrence is that
    of the smallest id (null first), then text hash, then line; rows that repeat an id and a text
    are one document and keep the same lines. Null texts stay null; a text with fewer lines than
    ``window`` stays whole. Texts stay in place while the list of repeated windows fits a broadcast.
    """
    columns = [c for c in docs.columns if c not in ("_n_lines", "_n_removed")]
    return _cut(docs, id_col, text_col, window).select(*_given(columns, text_col), "_n_lines", "_n_removed")


def drop_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """``docs`` with repeated lines removed, without the documents that lose their last line by it."""
    cut = _cut(docs, id_col, text_col, window)
    cut = cut.where((F.col("_n_removed") == 0) | (F.col("_n_removed") < F.col("_n_lines")))
    return cut.select(*_given(docs.columns, text_col))
