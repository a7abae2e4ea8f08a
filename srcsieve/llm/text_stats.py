"""Statistics of a text as native column expressions, in one narrow stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from srcsieve.llm.common import SPACE

WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct_words", "n_upper", "n_digits", "n_marks",
)


def bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once, however often the body refers to it."""
    return F.transform(F.array(value), body)[0]


def _twins(ranked: Column) -> Column:
    """Sorted positions of those ``(h, i)`` whose ``h`` a neighbour in sorted order shares."""

    def shared(e: Column, k: Column) -> Column:
        after = F.get(ranked, k + 1)["h"]
        before = F.when(k > 0, F.get(ranked, k - 1)["h"])
        return F.coalesce(after == e["h"], F.lit(False)) | F.coalesce(before == e["h"], F.lit(False))

    return F.sort_array(F.transform(F.filter(ranked, shared), lambda e: e["i"]))


def _covered(positions: Column) -> Column:
    """Words covered by the windows that start at the sorted ``positions``."""
    steps = F.transform(
        F.slice(positions, 2, F.greatest(F.size(positions) - 1, F.lit(0))),
        lambda p, k: F.least(F.lit(WINDOW), p - F.get(positions, k)),
    )
    return F.aggregate(steps, F.lit(WINDOW), lambda total, step: total + step)


def repeated_words(words: Column) -> Column:
    """Words in windows of five words that occur twice or more, the first occurrence included.

    Windows are compared by a 64-bit hash within one text.
    """
    starts = F.when(F.size(words) >= WINDOW, F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))).otherwise(
        F.array().cast("array<int>")
    )

    def count(hashes: Column) -> Column:
        ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        covered = bound(bound(ranked, _twins), _covered)
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered)

    return bound(F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, WINDOW))), count)


def with_counts(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with a struct ``_counts`` of ``COUNTS`` for ``text``; a null text has no words.

    A word is a run without white space. A line counts if it has a word, and as a duplicate if an
    equal line stands before it.
    """
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, SPACE + "+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    of_words = bound(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.aggregate(w, F.lit(0).cast("long"), lambda total, word: total + F.length(word)).alias("word_chars"),
        repeated_words(w).cast("long").alias("n_repeat_words"),
        F.size(F.array_distinct(w)).cast("long").alias("n_distinct_words"),
    ))
    of_lines = bound(lines, lambda n: F.struct(
        F.size(n).cast("long").alias("n_lines"),
        (F.size(n) - F.size(F.array_distinct(n))).cast("long").alias("n_dup_lines"),
    ))
    matches = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("long")
    staged = docs.withColumns({"_of_words": of_words, "_of_lines": of_lines})
    place = {"n_lines": "_of_lines", "n_dup_lines": "_of_lines"}
    patterns = {"n_symbols": SYMBOLS, "n_upper": "[A-Z]", "n_digits": "[0-9]", "n_marks": "[!?]"}
    counts = [
        (matches(patterns[c]) if c in patterns else F.col(place.get(c, "_of_words"))[c]).alias(c) for c in COUNTS
    ]
    return staged.withColumn("_counts", F.struct(*counts)).drop("_of_words", "_of_lines")


def features(count) -> dict[str, Column]:
    """Ratios that rules and models look at, from ``count(name)``; all are 0 for an empty text."""
    ratio = lambda a, b: F.when(count(b) > 0, count(a) / count(b)).otherwise(F.lit(0.0))
    return {
        "words": count("n_words").cast("double"),
        "word_length": ratio("word_chars", "n_words"),
        "symbols": ratio("n_symbols", "n_words"),
        "upper": ratio("n_upper", "word_chars"),
        "digits": ratio("n_digits", "word_chars"),
        "marks": ratio("n_marks", "n_words"),
        "dup_lines": ratio("n_dup_lines", "n_lines"),
        "repeats": ratio("n_repeat_words", "n_words"),
        "distinct": ratio("n_distinct_words", "n_words"),
        "line_words": ratio("n_words", "n_lines"),
    }
