"""The running latest event per repository, as keyed state that forgets.

``stream_latest_per_repo`` emits every repository of every micro-batch and leaves the merging to readers. Here
the state holds what was emitted, so only news comes out, and a time to live bounds the state by the repositories
active within it instead of by all that were ever met.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from srcsieve.session import ship_package
from srcsieve.streaming.archive_stream import write_batches

SCHEMA = "repo_name string, created_at string"
#: State with a time to live needs this store. A query by processing time would ask for micro-batches without rows
#: for ever, and so never be drained.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
#: A repository that was silent for so long is forgotten.
TTL_MS = 30 * 24 * 3600 * 1000


def latest_event(ttl_ms: int = TTL_MS) -> StatefulProcessor:
    """Emits a repository when it is new or has a later event than the state holds.

    Every event of a repository renews its time to live. One without any time is emitted once, with a null. The
    class is a local one, so that it travels by value: Spark also loads it in a process of the driver's machine that
    does not see packages sent to the executors.
    """

    class LatestEvent(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.latest = handle.getValueState("latest", "created_at string", ttl_ms)

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            known = self.latest.get() if self.latest.exists() else None
            held = latest = known[0] if known else None
            for batch in rows:
                times = [time for time in batch["created_at"] if isinstance(time, str)]
                latest = max(times + [latest] * (latest is not None), default=None)
            self.latest.update((latest,))
            if known is None or latest != held:
                yield pd.DataFrame({"repo_name": [key[0]], "created_at": [latest]})

        def close(self) -> None:
            pass

    return LatestEvent()


def newest(times: Iterable[str | None]) -> str | None:
    """The latest of ISO times, which order as texts; nulls count for nothing."""
    return max((time for time in times if isinstance(time, str)), default=None)


def newest_per_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The latest event per repository of each Arrow batch: combined before the shuffle, so a repository that holds
    a third of all events costs its task one row per batch."""
    for batch in batches:
        yield batch.groupby("repo_name", sort=False, dropna=False)["created_at"].agg(newest).reset_index()


def running_latest(events: DataFrame, ttl_ms: int = TTL_MS) -> DataFrame:
    """``(repo_name, created_at)`` whenever a repository gets a later event, from a stream of events.

    The state is one value per repository that had an event within ``ttl_ms`` of processing time. A repository
    that comes back after it counts as new, and may be emitted with a time that was emitted before or an earlier
    one; ``archive_stream.merge_latest`` over all that was emitted is the latest event per repository in any case.
    The query needs ``SETTINGS`` (``start_running_latest`` sees to it).
    """
    ship_package(events.sparkSession)
    combined = events.select("repo_name", "created_at").mapInPandas(newest_per_batch, SCHEMA)
    return combined.groupBy("repo_name").transformWithStateInPandas(
        latest_event(ttl_ms), SCHEMA, "Update", "ProcessingTime"
    )


def start_running_latest(events: DataFrame, path: str, checkpoint: str, ttl_ms: int = TTL_MS) -> StreamingQuery:
    """Write the news of each micro-batch to ``path/batch=N``, drain what has arrived and stop.

    A restart takes the state from ``checkpoint``. ``SETTINGS`` hold for this query alone: a query keeps the
    settings of the session at its start, and other streams of the session may have state in another store.
    """
    conf = events.sparkSession.conf
    before = {name: conf.get(name, None) for name in SETTINGS}
    try:
        for name, value in SETTINGS.items():
            conf.set(name, value)
        return write_batches(running_latest(events, ttl_ms), path, checkpoint, "update")
    finally:
        for name, value in before.items():
            conf.unset(name) if value is None else conf.set(name, value)


def held_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What the state of ``running_latest`` holds after its last micro-batch: ``(repo_name, created_at)``.

    Values whose time ran out stay until the next micro-batch that has rows.
    """
    state = spark.read.format("statestore").option("stateVarName", "latest").load(checkpoint)
    return state.selectExpr("key.repo_name AS repo_name", "value.value.created_at AS created_at")
