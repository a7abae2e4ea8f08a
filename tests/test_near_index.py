"""The kept index of near duplicates against one pass over all records."""

import random

import pytest
from pyspark.sql import functions as F

from srcsieve.operators import minhash
from srcsieve.operators import near_index as N
from srcsieve.operators.fuzzy_dedup import deduplicate
from srcsieve.session import read_runs, scratch_path
from tests.test_dedup import near_copies, words

RECORD = "repo_name string, file_name string, text string, run int"


def corpus(seed=2):
    """Near copies over three runs, exact copies, files collected again, a null and an empty text."""
    rng = random.Random(seed)
    rows = [(f"r{i % 7}", f"f{i}", text, rng.randint(1, 3)) for i, text in near_copies()]
    rows += [(f"again{i}", "copy", rows[i][2], rng.randint(1, 3)) for i in range(0, 60, 5)]
    rows += [(*rows[i][:3], rng.randint(1, 3)) for i in range(0, 60, 4)]
    rows += [rows[3], ("n", "null", None, 1), ("n", "null", None, 3), ("e", "empty", "", 2), (None, "none", "no repository", 2)]
    return rows


def state_of(rows):
    return sorted(((r["repo_name"], r["file_name"], r["text"]) for r in rows), key=repr)


@pytest.fixture(scope="module")
def added(spark, tmp_path_factory):
    """Three runs with small groups treated as hot; the files of the first two are gone before the third comes."""
    frame, landed = spark.createDataFrame(corpus(), RECORD), tmp_path_factory.mktemp("landed")
    index, updates = scratch_path(spark, "near-index"), {}
    for run in (1, 2, 3):
        path = landed / str(run)
        frame.where(F.col("run") == run).drop("run").write.parquet(str(path))
        update = N.add_to_index(spark.read.parquet(str(path)), index, run, hot_key_rows=3)
        updates[run] = (update.kept.collect(), {r["my_id"] for r in update.retracted.collect()})
        for file in path.iterdir():
            file.unlink()
    return frame, index, updates


def test_runs_keep_what_one_pass_keeps(spark, added):
    frame, index, updates = added
    kept = []
    for run in (1, 2, 3):
        rows, retracted = updates[run]
        kept = [r for r in kept if r["my_id"] not in retracted] + rows
    want = deduplicate(frame.drop("run")).collect()
    assert state_of(kept) == state_of(want)
    ids = sorted(r["my_id"] for r in kept)
    assert ids == sorted(r["my_id"] for r in N.kept_ids(spark, index).collect()) and len(ids) == len(set(ids))
    assert any(retracted for _, retracted in updates.values())


def test_the_last_run_can_be_done_again_also_on_a_compacted_copy(spark, added):
    frame, index, updates = added
    labels = sorted(map(tuple, N.index_labels(spark, index).collect()))
    third = frame.where("run = 3").drop("run")
    copy = scratch_path(spark, "near-index")
    N.compact_index(spark, index, copy, 2)
    for folder in (index, copy):
        update = N.add_to_index(third, folder, 3)
        assert {r["my_id"] for r in update.kept.collect()} == {r["my_id"] for r in updates[3][0]}
        assert {r["my_id"] for r in update.retracted.collect()} == updates[3][1]
        assert sorted(map(tuple, N.index_labels(spark, folder).collect())) == labels
    with pytest.raises(ValueError):
        N.add_to_index(third, index, 2)


def chain(rng):
    """Texts of which each is a near copy of the next, but the ends are not of each other."""
    parts = words(rng, 150).split(" ")
    texts = []
    for step in range(6):
        texts.append(" ".join(parts))
        parts[step * 2 % 150] = words(rng, 1)
    return texts


def test_a_run_joins_groups_of_earlier_runs(spark):
    """Chains that arrive link by link, in several orders; untouched groups are not labelled anew."""
    rng = random.Random(9)
    rows = []
    for c, order in enumerate([(0, 1, 2, 3, 4, 5), (5, 0, 3, 1, 4, 2), (1, 4, 0, 5, 2, 3), (0, 2, 4, 5, 1, 3)]):
        texts = chain(rng)
        rows += [(f"c{c}", f"f{at}", texts[at], turn // 3 + 1) for turn, at in enumerate(order)]
    rows += [(f"alone{i}", "f", words(rng, 100), 1) for i in range(40)]
    frame, index, kept = spark.createDataFrame(rows, RECORD), scratch_path(spark, "near-index"), []
    for run in (1, 2):
        update = N.add_to_index(frame.where(F.col("run") == run).drop("run"), index, run)
        retracted = {r["my_id"] for r in update.retracted.collect()}
        kept = [r for r in kept if r["my_id"] not in retracted] + update.kept.collect()
    assert state_of(kept) == state_of(deduplicate(frame.drop("run")).collect())
    assert 12 <= spark.read.parquet(f"{index}/labels/run=2").count() <= 24


def test_an_empty_run(spark):
    frame, index = spark.createDataFrame(corpus()[:12], RECORD).drop("run"), scratch_path(spark, "near-index")
    assert N.add_to_index(frame.limit(0), index, 1).kept.collect() == []
    assert state_of(N.add_to_index(frame, index, 2).kept.collect()) == state_of(deduplicate(frame).collect())


def test_an_index_without_runs_needs_no_python(spark, tmp_path):
    rows = read_runs(spark, str(tmp_path / "heads"), N.HEADS)
    assert rows.dtypes == [("band", "int"), ("bucket", "binary"), ("head", "string")] and rows.isEmpty()
    assert "ExistingRDD" not in rows._jdf.queryExecution().toString()


def test_buckets_of_a_run_are_grouped_once(spark, tmp_path, monkeypatch):
    grouped, group = [], minhash.bucket_heads
    for module in (N, minhash):
        monkeypatch.setattr(module, "bucket_heads", lambda *args: grouped.append(args) or group(*args))
    rows = spark.createDataFrame([("r", "a", "x" * 50), ("r", "b", "x" * 50)], "repo_name string, file_name string, text string")
    assert N.add_to_index(rows, str(tmp_path / "index"), 1).kept.count() == 1
    assert len(grouped) == 1
