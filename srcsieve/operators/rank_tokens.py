"""Token counts by the merge ranks of a trained byte-pair vocabulary.

A vocabulary file holds one ``base64(token) rank`` per line, lowest rank first. Spark reads it, from any store, and
every worker gets the ranks as a broadcast variable; texts are counted in Arrow batches where they lie.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, SparkSession, functions as F

#: How byte-pair vocabularies of the public kind cut a text into words before merging; a fixed value.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The largest vocabulary that is sent to every worker; a larger one raises.
MAX_RANKS = 1_000_000
#: Words remembered per worker, and the longest of them; the rest is counted each time.
MAX_WORDS, MAX_WORD_BYTES = 200_000, 64


def read_ranks(spark: SparkSession, path: str, max_ranks: int = MAX_RANKS) -> dict[bytes, int]:
    """The vocabulary of ``path``, at most ``max_ranks`` tokens; blank lines are skipped."""
    parts = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).where(F.trim("value") != "")
    found = rows.select(F.unbase64(parts[0]).alias("token"), parts[1].cast("int").alias("rank")).limit(max_ranks + 1).collect()
    if len(found) > max_ranks:
        raise ValueError(f"{path} has more than {max_ranks} tokens")
    ranks = {bytes(row["token"]): row["rank"] for row in found}
    missing = [byte for byte in range(256) if bytes([byte]) not in ranks]
    if missing:
        raise ValueError(f"{path} has no token for the bytes {missing[:8]}")
    return ranks


def piece_count(word: bytes, ranks: dict[bytes, int]) -> int:
    """Pieces that are left of ``word`` when neighbours are merged, lowest rank first and leftmost among equals.

    A priority queue holds the mergeable neighbours, so a word of n bytes takes n log n steps however long it is.
    """
    if not word or word in ranks:
        return len(word) and 1
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n))  # of the piece that starts here; 0: none starts here any more
    queue: list[tuple[int, int, int]] = []

    def offer(start: int) -> None:
        middle = end[start]
        if middle < n and (rank := ranks.get(word[start : end[middle]])) is not None:
            heapq.heappush(queue, (rank, start, end[middle]))

    for start in range(n):
        offer(start)
    pieces = n
    while queue:
        _, start, stop = heapq.heappop(queue)
        middle = end[start]
        if not middle or middle >= n or end[middle] != stop:
            continue  # one of the two was merged with another since
        end[start], end[middle] = stop, 0
        before[stop] = start
        pieces -= 1
        offer(start)
        if before[start] >= 0:
            offer(before[start])
    return pieces


def rank_token_count(spark: SparkSession, path: str, pattern: str = WORDS) -> Callable[[Column], Column]:
    """A function from a text column to its number of tokens by the vocabulary at ``path``; null for null."""
    shared = spark.sparkContext.broadcast(read_ranks(spark, path))

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import regex

        ranks, cut, known = shared.value, regex.compile(pattern), {}

        def tokens(word: str) -> int:
            found = known.get(word)
            if found is None:
                data = word.encode()
                found = piece_count(data, ranks)
                if len(data) <= MAX_WORD_BYTES:
                    if len(known) >= MAX_WORDS:
                        known.clear()
                    known[word] = found
            return found

        def of_text(text: str | None) -> int | None:
            if text is None:
                return None
            return sum(times * tokens(word) for word, times in Counter(m.group() for m in cut.finditer(text)).items())

        for texts in batches:
            yield pd.Series([of_text(text) for text in texts], dtype="Int64")

    return count
