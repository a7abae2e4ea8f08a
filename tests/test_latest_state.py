"""Keyed state with a time to live: news only, restarts, and what is forgotten."""

import json
import time

from srcsieve.streaming import archive_stream as A
from srcsieve.streaming import latest_state as L


def setup(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    sink, offsets = str(tmp_path / "out"), str(tmp_path / "offsets")

    def run(name, events, ttl_ms=L.TTL_MS):
        lines = [json.dumps({"type": "PushEvent", "repo": {"name": r}, "created_at": at}) for r, at in events]
        (folder / name).write_text("\n".join(lines))
        stream = A.stream_archive_events(spark, str(folder), files_per_trigger=1)
        L.start_running_latest(stream, sink, offsets, ttl_ms).awaitTermination()

    emitted = lambda: A.read_batches(spark, sink, spark.createDataFrame([], L.SCHEMA).schema)
    return run, emitted, offsets


def at(day):
    return f"2025-01-{day:02d}T00:00:00Z"


def test_only_news_is_emitted_across_restarts(spark, tmp_path):
    run, emitted, offsets = setup(spark, tmp_path)
    run("a.json", [("o/a", at(3)), ("o/a", at(2)), ("o/b", at(1)), ("o/null", None)])
    run("b.json", [("o/a", at(1)), ("o/a", at(3)), ("o/b", at(4)), ("o/null", None)])  # a restart with the state
    run("c.json", [("o/c", at(1)), ("o/b", at(2))])
    got = sorted((r.repo_name, r.created_at or "") for r in emitted().collect())
    assert got == [("o/a", at(3)), ("o/b", at(1)), ("o/b", at(4)), ("o/c", at(1)), ("o/null", "")]
    merged = {r.repo_name: r.created_at for r in A.merge_latest(emitted()).collect()}
    assert merged == {"o/a": at(3), "o/b": at(4), "o/c": at(1), "o/null": None}
    assert {r.repo_name: r.created_at for r in L.held_state(spark, offsets).collect()} == merged


def test_state_is_bounded_by_its_time_to_live(spark, tmp_path):
    run, emitted, offsets = setup(spark, tmp_path)
    run("a.json", [(f"o/{n}", at(9)) for n in range(50)], ttl_ms=2000)
    time.sleep(2.5)
    run("b.json", [("o/new", at(1)), ("o/7", at(5))], ttl_ms=2000)
    time.sleep(2.5)
    run("c.json", [("o/last", at(1))], ttl_ms=2000)
    held = {r.repo_name for r in L.held_state(spark, offsets).collect()}
    assert held == {"o/last"}  # not the 52 that were met
    merged = {r.repo_name: r.created_at for r in A.merge_latest(emitted()).collect()}
    assert len(merged) == 52 and merged["o/7"] == at(9)  # forgotten, emitted again, and still right


def test_other_streams_keep_their_state_store(spark, tmp_path):
    before = [spark.conf.get(name, None) for name in L.SETTINGS]
    run, emitted, _ = setup(spark, tmp_path)
    run("a.json", [])
    assert [spark.conf.get(name, None) for name in L.SETTINGS] == before
    assert emitted().count() == 0


def test_batches_are_combined_before_the_shuffle():
    import pandas as pd

    hot = pd.DataFrame({"repo_name": ["o/hot"] * 1000 + [None, "o/a"], "created_at": [at(1 + i % 9) for i in range(1000)] + [at(2), None]})
    (got,) = L.newest_per_batch(iter([hot]))
    assert len(got) == 3 and got.created_at[0] == at(9)
