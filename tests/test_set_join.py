"""The exact similarity join against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from srcsieve.operators import set_join as J
from tests.test_dedup import shingle_set, union_find, words


def edited(rng, text, changes):
    parts = text.split(" ")
    for at in rng.sample(range(len(parts)), changes):
        parts[at] = words(rng, 1)
    return " ".join(parts)


def corpus():
    """Families of edited copies, chains, a passage that many share, copies, short and missing texts."""
    rng, rows = random.Random(8), []
    passage = words(rng, 30)
    for _ in range(12):
        base = words(rng, 120)
        rows += [base, *(edited(rng, base, rng.randint(0, 5)) for _ in range(rng.randint(0, 5)))]
    link = words(rng, 150)
    for _ in range(8):
        rows.append(link)
        link = edited(rng, link, 3)
    rows += [passage + " " + words(rng, rng.choice((8, 60))) for _ in range(12)]
    rows += [rows[3], rows[3], rows[20], "", "short", "short", "shorter", None, None, "x" * 300, "x" * 400]
    rng.shuffle(rows)
    return list(enumerate(rows))


def jaccard(a, b):
    a, b = shingle_set(a or "", 24), shingle_set(b or "", 24)
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("hot", [3])
def test_groups_are_those_of_all_pairs(spark, hot):
    rows = corpus()
    links = [(i, j) for i, a in rows for j, b in rows if j < i and jaccard(a, b) >= 0.8]
    roots = union_find(links)
    want = {i: roots.get(i, i) for pair in links for i in pair}
    docs = spark.createDataFrame([*rows, (None, "no id")], "id long, text string").withColumns(
        {name: F.lit("x") for name in ("root", "size", "place", "digest", "shingle", "head", "jaccard")}
    )
    found = J.similarity_groups(docs, hot_key_rows=hot).collect()
    assert {r["id"]: r["root"] for r in found} == want and len(found) == len(want)
    text = dict(rows)
    for r in found:
        assert r["partner"] != r["id"] and want[r["partner"]] == r["root"]
        assert r["jaccard"] >= 0.8 and abs(jaccard(text[r["id"]], text[r["partner"]]) - r["jaccard"]) < 1e-12


def test_no_two_members_of_a_group_meet_again(spark):
    """A large family is compared with its head only."""
    rows = [(token, doc, 10, 0, root) for token in (1, 2) for doc, root in [*((d, 0) for d in range(500)), (900, 900), (901, 901)]]
    labelled = spark.createDataFrame(rows, "shingle long, id long, size int, place int, root long")
    shapes = labelled.select("id", "size").distinct().withColumn("slots", F.array(F.lit(10)))
    pairs = J._cross_pairs(labelled, shapes, 0.8, 1_000_000).collect()
    assert len(pairs) == 2 * 500 + 1 and all((r["id"] >= 900) != (r["head"] >= 900) or r["id"] + r["head"] == 1801 for r in pairs)


def test_groups_do_not_depend_on_the_order_of_shingles(spark, monkeypatch):
    """What is known of common shingles moves places, not links."""
    docs = spark.createDataFrame(corpus(), "id long, text string")
    want = sorted((r["id"], r["root"]) for r in J.similarity_groups(docs).collect())
    monkeypatch.setattr(J, "ORDER_DOCUMENTS", 4)
    assert sorted((r["id"], r["root"]) for r in J.similarity_groups(docs).collect()) == want


def test_only_prefixes_leave_the_task_of_a_text(spark):
    docs = spark.createDataFrame([(1, "a" * 23), (2, words(random.Random(5), 90)), (3, None)], "id long, text string")
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for r in J.outlines(docs, 0.8, none).collect():
        assert len(r.prefix) == r["size"] - -(-r["size"] * 4 // 5) + 1 and sum(r.slots) == r["size"]
    own = np.array([1, 4, 6, 9], np.uint64)
    assert J._ordered(own, np.array([4, 5, 9], np.uint64), np.array([7, 2, 3])).tolist() == [1, 6, 9, 4]


def test_least_overlap_of_a_prefix(spark):
    sizes = spark.range(1, 200).select(J.least_overlap(F.col("id"), 0.8).alias("n"), "id").collect()
    assert all(r["n"] == -(-r["id"] * 4 // 5) for r in sizes)


def test_empty_table(spark):
    assert J.similarity_groups(spark.createDataFrame([], "id long, text string")).collect() == []


@pytest.mark.parametrize("kind", ["long", "string"])
def test_prefix_shingles_move_packed(spark, monkeypatch, kind):
    """Holders of a shingle meet their head; only rows of shingles with three holders or more come back."""
    monkeypatch.setattr(J, "BLOCK_KEYS", 300)
    monkeypatch.setattr(J, "OUT_ROWS", 7)
    docs = spark.createDataFrame(corpus(), "id long, text string").dropDuplicates(["text"]).withColumn("id", F.col("id").cast(kind))
    drawn = J.outlines(docs, 0.8, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    size, holders = {}, {}
    for r in drawn.collect():
        size[r["id"]] = r["size"]
        for place, shingle in enumerate(r["prefix"]):
            holders.setdefault(shingle, {})[r["id"]] = place
    near = lambda a, b: min(size[a], size[b]) >= max(size[a], size[b]) * 0.8 - 1e-9
    pairs, rows = J.prefix_meetings(drawn, 0.8, 5)
    assert sorted(map(tuple, pairs.collect())) == sorted({(i, min(h)) for h in holders.values() for i in h if i != min(h) and near(i, min(h))})
    got = {}
    for r in rows.collect():
        got.setdefault(r["shingle"], {})[r["id"]] = r["place"]
        assert r["size"] == size[r["id"]]
    want = [h for h in holders.values() if len(h) > 2]
    assert want and sorted(map(sorted, got.values())) == sorted(map(sorted, want))
    highest = lambda found: {i: max(h[i] for h in found if i in h) for h in found for i in h}
    low, high = highest(got.values()), highest(want)
    assert all(high[i] - size[i] / 256 - 1 <= low[i] <= high[i] for i in high)


def test_a_row_that_comes_twice_is_no_link(spark):
    rng = random.Random(2)
    alone, pair = words(rng, 90), words(rng, 90)
    rows = [(1, alone), (1, alone), (2, pair), (3, pair + " x"), (3, pair + " x"), (4, words(rng, 400)), (4, pair + " y")]
    found = J.similarity_groups(spark.createDataFrame(rows, "id long, text string")).select("id", "root")
    assert {(r["id"], r["root"]) for r in found.collect()} == {(2, 2), (3, 2), (4, 2)}
