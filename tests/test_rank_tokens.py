"""Merge-rank token counts against a tokenizer library and against repeated scans."""

import base64
import random
import time

import pytest

from srcsieve.operators import quality as G
from srcsieve.operators import rank_tokens as R

tokenizers = pytest.importorskip("public_tokenizers")
FILE = "byte_bpe_50k.tiktoken"
TEXTS = [
    None, "", " ", "\n\n  \t x", "def f(x):\n    return x + 1  # it's ours, they'll see\n", "naïve café — 東京 🎌🎌 ½ Ⅷ",
    "a" * 5000, "  x\u0000y﻿", "x" * 70 + " " + "0123456789" * 30, "<|endoftext|> WE'RE we're",
]


def by_scans(word, ranks):
    """Merge the leftmost pair of lowest rank until there is none."""
    parts = [word[i : i + 1] for i in range(len(word))]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs or len(parts) < 2:
            return len(parts)
        i = min(pairs)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_counts_equal_the_library(spark):
    tiktoken = pytest.importorskip("tiktoken")
    ranks = R.read_ranks(spark, tokenizers.path(FILE))
    model = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    pages = [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    texts = TEXTS + pages + ["".join(random.Random(3).choices("ab \n'sé1_東", k=400)) for _ in range(50)]
    count = R.rank_token_count(spark, tokenizers.path(FILE), tokenizers.PATTERN)
    got = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3).select("id", count("text").alias("n")).collect()
    assert {r.id: r.n for r in got} == {i: t if t is None else len(model.encode_ordinary(t)) for i, t in enumerate(texts)}
    default = R.rank_token_count(spark, tokenizers.path(FILE))
    row = spark.createDataFrame([(TEXTS[4],)], "text string").select(default("text")).first()
    assert row[0] == len(model.encode_ordinary(TEXTS[4]))


def test_merges_by_brute_force():
    rng = random.Random(11)
    for _ in range(300):
        ranks = {bytes([b]): b for b in b"abc"}
        while len(ranks) < 15:
            token = b"".join(rng.choices(list(ranks), k=2))
            ranks.setdefault(token, len(ranks) + rng.randrange(3))
        word = bytes(rng.choices(b"abc", k=rng.randrange(1, 25)))
        if word not in ranks:
            assert R.piece_count(word, ranks) == by_scans(word, ranks), (word, ranks)
    assert R.piece_count(b"", {}) == 0


def test_a_word_of_a_million_bytes_takes_seconds():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 300, b"abab": 301}
    began = time.time()
    assert R.piece_count(b"ab" * 200_000, ranks) == 100_000
    assert time.time() - began < 20


def test_vocabularies_that_cannot_be_used_raise(spark, tmp_path):
    few = tmp_path / "few.tiktoken"
    few.write_text("\n".join(f"{base64.b64encode(bytes([b])).decode()} {b}" for b in range(200)))
    with pytest.raises(ValueError, match="bytes"):
        R.read_ranks(spark, str(few))
    with pytest.raises(ValueError, match="more than"):
        R.read_ranks(spark, str(few), max_ranks=100)


def test_fertility_by_the_vocabulary(spark):
    rows = spark.createDataFrame([("plain english words are cheap to write",), ("0xqz9!7@#zx%^",), (None,), ("",)], "text string")
    kept = G.token_fertility_filter(rows, tokenizer=tokenizers.path(FILE)).collect()
    assert [r.text for r in kept] == ["plain english words are cheap to write"]
    empty = G.quality_filter_chain(spark.createDataFrame([], "language string, text string"), tokenizers.path(FILE))
    assert empty.count() == 0
