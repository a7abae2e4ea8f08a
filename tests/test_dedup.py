import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from srcsieve.operators import batches as B
from srcsieve.operators import components as C
from srcsieve.operators import exact_dedup as E
from srcsieve.operators import fuzzy_dedup as Z
from srcsieve.operators import minhash as M


def union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent if find(x) != x}


GRAPHS = {
    "path": [(i + 1, i) for i in range(60)],
    "shuffled path": [((i * 37 + 37) % 61, (i * 37) % 61) for i in range(60)],
    "star": [(i, 0) for i in range(1, 80)],
    "high star": [(100, i) for i in range(80)],
    "random": [(random.Random(7 + i).randrange(300), random.Random(900 + i).randrange(300)) for i in range(220)],
    "loops only": [(3, 3)],
}


@pytest.mark.parametrize("name", GRAPHS)
@pytest.mark.parametrize("hot", [5, 1_000_000])
def test_components(spark, name, hot):
    edges = spark.createDataFrame(GRAPHS[name], "id long, head long")
    got = C.duplicate_components(edges, hot_key_rows=hot).collect()
    assert {r.id: r.root for r in got} == union_find(GRAPHS[name])
    assert len(got) == len({r.id for r in got})


def test_components_must_settle(spark):
    edges = spark.createDataFrame(GRAPHS["path"], "id long, head long")
    with pytest.raises(RuntimeError):
        C.duplicate_components(edges, max_rounds=1)


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(n))


def near_copies():
    rng = random.Random(1)
    rows = []
    for i in range(60):
        text = words(rng, 150)
        rows.append((i * 10, text))
        parts = text.split(" ")
        for copy, changes in enumerate((0, 1, 2, 30)):
            changed = list(parts)
            for at in rng.sample(range(len(parts)), changes):
                changed[at] = words(rng, 1)
            rows.append((i * 10 + 1 + copy, " ".join(changed)))
    return rows


def shingle_set(text, n):
    return {text[i : i + n] for i in range(max(len(text) - n + 1, 1))}


def test_shingle_hashes_count_like_strings():
    rng = random.Random(11)
    texts = ["", "a", "ab", "x" * 24, "x" * 500, words(rng, 500), words(rng, 500) + "é日😀" * 40, "\0" * 30, "\0" * 23]
    for window in (1 << 20, 50):
        sets = Z.ShingleSets(24, window)
        for a in texts:
            assert len(sets.of(a)) == len(shingle_set(a, 24))
            for b in texts:
                shared = np.intersect1d(sets.of(a), sets.of(b), assume_unique=True)
                assert len(shared) == len(shingle_set(a, 24) & shingle_set(b, 24))


def test_signature_estimates_jaccard():
    rng = random.Random(3)
    signer = M.Signer(24, 2600, 42)
    for keep in (0.95, 0.8, 0.5):
        left = words(rng, 400)
        cut = int(len(left) * keep)
        right = left[:cut] + words(rng, 400)[: len(left) - cut]
        a, b = shingle_set(left, 24), shingle_set(right, 24)
        truth = len(a & b) / len(a | b)
        assert abs(np.mean(signer.sign(left) == signer.sign(right)) - truth) < 0.04


def test_signature_does_not_depend_on_blocks(monkeypatch):
    text = words(random.Random(5), 3000) + "é日😀"
    whole = M.Signer(24, 26, 42).sign(text)
    monkeypatch.setattr(M, "WINDOW", 97)
    monkeypatch.setattr(M, "BLOCK", 13)
    assert (M.Signer(24, 26, 42).sign(text) == whole).all()
    assert len(M.Signer(24, 26, 42).sign("")) == 26


def test_recall(spark):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "id long, text string")
    removed = {r.id for r in Z.fuzzy_duplicates(docs, "id").collect()}
    sets = {i: shingle_set(t, 24) for i, t in rows}
    probability = found = 0.0
    for i, shingles in sets.items():
        base = sets[i - i % 10]
        if i % 10:
            j = len(base & shingles) / len(base | shingles)
            probability += 1 - (1 - j**13) ** 20
            found += i in removed
    assert abs(found - probability) < 12
    assert all(i % 10 for i in removed)


def test_dedup_does_not_depend_on_partitions(spark):
    docs = spark.createDataFrame([(i, f"r{i % 7}", f"f{i}", t, i % 2, 0) for i, t in near_copies()],
                                 "id long, repo_name string, file_name string, text string, month int, batch int")
    first = {r.my_id for r in Z.deduplicate(docs).collect()}
    again = {r.my_id for r in Z.deduplicate(docs.repartition(7, "file_name")).collect()}
    assert first == again
    kept = Z.deduplicate(docs)
    assert Z.deduplicate(kept.drop("my_id")).count() == kept.count()
    exact = E.exact_dedup(E.add_doc_id(docs))
    assert first <= {r.my_id for r in exact.collect()}


def test_scope(spark):
    text = words(random.Random(9), 100)
    rows = [(f"r{i}", "f", text + (" tail" if i % 2 else ""), i // 4, i % 4 // 2) for i in range(8)]
    docs = spark.createDataFrame(rows, "repo_name string, file_name string, text string, month int, batch int")
    assert {s: Z.deduplicate(docs, s).count() for s in ("global", "month", "batch")} == {"global": 1, "month": 2, "batch": 4}


def test_identical_rows_keep_one(spark):
    rows = [("r", "f", "same", 1)] * 5 + [("r", "g", "same", 2)] * 3 + [("r", "h", "other", 3)] + [("r", "i", None, 4)]
    docs = E.add_doc_id(spark.createDataFrame(rows, "repo_name string, file_name string, text string, x int"))
    got = E.exact_dedup(docs).collect()
    assert sorted(r.text or "" for r in got) == ["", "other", "same"]


def test_hot_bucket(spark):
    rows = [(i, "licence " * 40) for i in range(200)] + [(1000 + i, words(random.Random(i), 60)) for i in range(20)]
    buckets = M.document_buckets(spark.createDataFrame(rows, "id long, text string"), "id")
    edges = sorted(map(tuple, M.lsh_candidate_edges(buckets, "id").collect()))
    assert edges == [(i, 0) for i in range(1, 200)]


def test_pairs_are_the_same_when_heads_are_split(spark):
    docs = spark.createDataFrame(near_copies(), "id long, text string")
    edges = spark.createDataFrame([(i * 10 + c, i * 10) for i in range(60) for c in range(1, 5)], "id long, head long")
    plain = sorted(map(tuple, Z.near_duplicate_pairs(edges, docs, threshold=0.5).collect()))
    split = sorted(map(tuple, Z.near_duplicate_pairs(edges, docs, threshold=0.5, hot_key_rows=2).collect()))
    assert plain == split and len(plain) >= 180
    checked = Z.fuzzy_duplicates(docs, "id", false_positive_check=True).count()
    assert 0 < checked <= Z.fuzzy_duplicates(docs, "id").count()


def test_char_shingles(spark):
    texts = ["", "short", "é😀" * 300, words(random.Random(2), 90)]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {}
    for row in M.char_shingles(docs, "id").collect():
        got.setdefault(row.id, set()).add(row.shingle)
    assert got == {i: shingle_set(t, 24) for i, t in enumerate(texts)}


def test_shingles_do_not_leave_the_task_of_their_text(spark, monkeypatch):
    monkeypatch.setattr(M, "PART_BYTES", 64)
    rows = [(i % 5, words(random.Random(i % 3), 40)) for i in range(12)] + [(None, "x" * 30), (None, None)]
    found = M.char_shingles(spark.createDataFrame(rows, "id int, text string"), "id")
    plan = found.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    want = {(i, s) for i, t in rows for s in shingle_set(t or "", 24)}
    got = list(map(tuple, found.collect()))
    assert set(got) == want and len(got) == len(want)


def test_texts_move_once_per_edge(spark):
    rng = random.Random(3)
    whole = words(rng, 80)
    docs = spark.createDataFrame([(i, f"{i} {whole}") for i in range(6)] + [(9, words(rng, 80)), (9, whole), (None, whole)], "id long, text string")
    edges = spark.createDataFrame([(3, 1), (4, 1), (4, 2), (9, 2), (7, 2), (None, 1)], "id long, head long")
    scored = Z.near_duplicate_pairs(edges, docs, hot_key_rows=2)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count(" Exchange") == 2  # both sides to the head, none by id
    assert sorted((r["id"], r["head"]) for r in scored.collect()) == [(3, 1), (4, 1), (4, 2), (9, 2)]


def test_the_set_of_a_text_is_taken_where_it_is_read(spark, monkeypatch):
    monkeypatch.setattr(M, "WINDOW", 50)
    rng = random.Random(9)
    texts = ["", None, "abc", "x" * 24, "x" * 200, "ab" * 99, "é😀\u0301" * 40, words(rng, 60) * 3, words(rng, 200), "ü" + words(rng, 50), "é" * 23]
    rows = [(str(i), t) for i, t in enumerate(texts)]
    found = M.char_shingles(spark.createDataFrame(rows, "id string, text string"), "id")
    assert "Aggregate" not in found._jdf.queryExecution().executedPlan().toString()
    for more in ([], [("3", words(rng, 30)), ("7", texts[7]), (None, "y" * 30), (None, None)]):
        every = spark.createDataFrame(rows + more, "id string, text string")
        got = list(map(tuple, M.char_shingles(every, "id").collect()))
        assert len(got) == len(set(got)) and set(got) == {(i, s) for i, t in rows + more for s in shingle_set(t or "", 24)}
    for n in (1, 5, 8, 24):
        codes = np.array([3, 1, 2] * 9, np.uint64)
        assert len(set(M.window_hashes(codes, n).tolist())) == 3 and len(M.window_hashes(codes, n)) == len(codes) - n + 1


def test_signatures_of_a_batch_come_in_small_parts(spark):
    rows = [(i, words(random.Random(i), 8) if i % 7 else None) for i in range(B.SLICE_ROWS * 2 + 5)]
    docs = spark.createDataFrame(rows, "id long, text string").coalesce(1)
    signer = M.Signer(24, 260, 42)
    got = {r.id: r.signature for r in M.minhash_signatures(docs, "id").collect()}
    assert got == {i: signer.sign(t or "").tolist() for i, t in rows}
    assert [len(part) for part in B.slices(pa.array(range(B.SLICE_ROWS + 3)))] == [B.SLICE_ROWS, 3]


def test_stars_are_settled_without_a_round(spark, monkeypatch):
    written, write = [], C.materialise
    monkeypatch.setattr(C, "materialise", lambda df, label: written.append(label) or write(df, label))
    stars = [(5, 1), (7, 1), (9, 2)]
    assert sorted(map(tuple, C.duplicate_components(spark.createDataFrame(stars, "id long, head long")).collect())) == stars
    assert written == ["edges"]
    for edges in ([(1, 5)], [(5, 1), (7, 5)], [(5, 1), (5, 2)], [(5, 1), (5, 1)]):  # upwards, a chain, two heads, a repeat
        assert not C._settled(spark.createDataFrame(edges, "u long, v long"))


def test_shared_values_of_sorted_sets(monkeypatch):
    def slow(*args, **options):
        raise AssertionError("np.unique and np.intersect1d take several times as long")

    monkeypatch.setattr(np, "unique", slow)
    monkeypatch.setattr(np, "intersect1d", slow)
    rng = random.Random(5)
    texts = ["", "a", words(rng, 300), words(rng, 300)]
    texts.append(texts[2][:900] + texts[3])
    sets = Z.ShingleSets(24, 200)
    for a in texts:
        for b in texts:
            assert Z.shared_values(sets.of(a), sets.of(b)) == len(shingle_set(a, 24) & shingle_set(b, 24))
