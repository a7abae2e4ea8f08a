"""The bucketed key state against a plain set."""

import random

from srcsieve.operators.key_state import KeyState
from srcsieve.session import child_names, scratch_path

SMALL = {"bucket_keys": 40, "buckets": 64}


def batch_of(spark, keys):
    return spark.createDataFrame([(k, n) for n, k in enumerate(keys)], "repo_name string, n int")


def names(frame):
    return sorted((r["repo_name"] for r in frame.collect()), key=str)


def test_batches_see_what_a_set_sees(spark):
    rng, path, seen = random.Random(3), scratch_path(spark, "state"), set()
    for number in range(6):
        keys = [rng.choice((None, "", f"o/{rng.randint(0, 60)}")) if rng.random() < 0.3 else f"n/{number}/{i}" for i in range(40)]
        keys = [None, None, ""] if number == 4 else keys
        state = KeyState(spark, path, compact_every=2, **SMALL)  # as after a restart
        got = names(state.unseen(batch_of(spark, keys), ["repo_name"], number))
        assert got == sorted((k for k in keys if k not in seen), key=str)
        seen.update(keys)
    assert state.generation == 2 and "gen=0" not in child_names(spark, path)


def test_a_retried_batch_sees_only_earlier_ones(spark):
    path = scratch_path(spark, "state")
    state = KeyState(spark, path, compact_every=2, **SMALL)
    for number, keys in enumerate((["a", "b"], ["b", "c"], ["c", "d"], ["a", "e"])):
        first = names(state.unseen(batch_of(spark, keys), ["repo_name"], number))
        again = KeyState(spark, path, compact_every=2, **SMALL)
        assert names(again.unseen(batch_of(spark, keys), ["repo_name"], number)) == first
    assert first == ["e"]


def test_a_batch_opens_only_buckets_it_may_hit(spark):
    state = KeyState(spark, scratch_path(spark, "state"), **SMALL)
    state.unseen(batch_of(spark, [f"old/{i}" for i in range(1500)]), ["repo_name"], 0)
    everything = state.opened
    assert everything == (0, 0)
    for number, keys in enumerate((["new/1", "new/2", "new/3"], ["old/7", "new/4"], ["old/8"] * 50), 1):
        state.unseen(batch_of(spark, keys), ["repo_name"], number).collect()
        old = {k for k in keys if k.startswith("old")}
        assert state.opened.filters <= len(set(keys)) and len(old) <= state.opened.keys <= len(old) + 1


def test_compaction_keeps_buckets_at_their_size(spark):
    state = KeyState(spark, scratch_path(spark, "state"), bucket_keys=10, buckets=2)
    keys = [f"k{i}" for i in range(300)]
    state.unseen(batch_of(spark, keys), ["repo_name"], 0)
    state.compact(1)
    assert state.buckets == 30
    assert names(state.unseen(batch_of(spark, [*keys, "k300"]), ["repo_name"], 1)) == ["k300"]


def test_wide_rows_and_empty_batches(spark):
    state = KeyState(spark, scratch_path(spark, "state"), **SMALL)
    rows = spark.createDataFrame([("a", "x", "t1"), ("a", "x", "t2"), ("a", None, "t3")], "repo string, file string, _digest string")
    assert state.unseen(rows.limit(0), ["repo", "file"], 0).collect() == []
    rows = rows.withColumnRenamed("_digest", "text")
    assert len(state.unseen(rows, ["repo", "file"], 1).collect()) == 3  # rows of a batch that share a key all stay
    more = rows.unionByName(spark.createDataFrame([("a", "", "t4")], rows.schema))
    assert [r["text"] for r in state.unseen(more, ["repo", "file"], 2).collect()] == ["t4"]


def test_keys_are_framed(spark):
    state = KeyState(spark, scratch_path(spark, "state"), **SMALL)
    state.unseen(spark.createDataFrame([("ab", "c")], "a string, b string"), ["a", "b"], 0)
    other = spark.createDataFrame([("a", "bc"), ("ab", "c")], "a string, b string")
    assert [tuple(r) for r in state.unseen(other, ["a", "b"], 1).collect()] == [("a", "bc")]
