"""Which keys were seen before: a state in hash buckets, of which a batch opens only those it may hit.

A generation folder ``gen=G`` holds, per bucket and batch, the 128-bit digests of the keys that came first in
that batch, and the non-zero words of a Bloom filter of them. A batch hashes its keys to buckets, tests them
against the filters of these buckets (the union of all batches' bits) and opens the keys of a bucket only where
some key passes. A key that passes is then looked up, so the filters save reading and never decide alone.

``compact`` writes the next generation with one file and one filter per bucket, and as many buckets as keep
a bucket at its size; the ``generations`` table says which one counts. A batch that is done again replaces its own
folders and reads only those of earlier batches.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from srcsieve.operators.joins import broadcast_limit, lookup_join
from srcsieve.session import child_names, drop_path, materialise, path_exists

#: Keys of a bucket, about, after a compaction.
BUCKET_KEYS = 50_000
#: Bits of a filter per key of a full bucket, and hash functions: about one in 400 new keys passes.
BITS_PER_KEY, HASHES = 16, 4
#: Most buckets; their numbers and filters are what a batch sends around.
MAX_BUCKETS = 1 << 14
#: What a digest takes in a hash table, about.
KEY_BYTES = 64
_KEYS = "digest binary"
_FILTER = "word int, bits long"


class Opened(NamedTuple):
    """How many bucket folders a batch opened: filters, and keys."""

    filters: int
    keys: int


def key_digest(*keys: str) -> Column:
    """128 bits of the key columns; null keys differ from empty ones."""
    parts = [F.coalesce(F.concat(F.length(k).cast("string"), F.lit(":"), F.col(k).cast("string")), F.lit("-")) for k in keys]
    return F.unhex(F.md5(F.concat(*parts).cast("binary")))


class KeyState:
    """The keys seen by the batches of one stream or job, below the folder ``path``."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        bucket_keys: int = BUCKET_KEYS,
        buckets: int = 16,
        compact_every: int = 64,
    ) -> None:
        self.spark, self.path, self.bucket_keys, self.compact_every = spark, path, bucket_keys, compact_every
        self.words = -(-bucket_keys * BITS_PER_KEY // 64)
        self.opened = Opened(0, 0)
        self.generation, self.buckets, self.upto = self._current(buckets)

    def _current(self, buckets: int) -> tuple[int, int, int]:
        """The newest generation: its number, its buckets, and the batch up to which it is compacted."""
        log = f"{self.path}/generations"
        if not path_exists(self.spark, log):
            return 0, buckets, -1
        rows = self.spark.read.schema("generation int, buckets int, upto long").parquet(log)
        return tuple(rows.orderBy(F.col("generation").desc()).first())

    def _folder(self, kind: str, generation: int | None = None) -> str:
        return f"{self.path}/gen={self.generation if generation is None else generation}/{kind}"

    def _bucket(self, buckets: int | None = None) -> Column:
        return F.pmod(F.xxhash64("digest"), F.lit(buckets or self.buckets)).cast("int")

    def _bits(self, keyed: DataFrame) -> DataFrame:
        """The bits of each key in the filter of its bucket, as ``word`` and ``bit``; ``needed`` counts a key's."""
        size = F.lit(self.words * 64)
        places = F.array_distinct(F.array(*[F.pmod(F.xxhash64("digest", F.lit(i)), size) for i in range(1, HASHES + 1)]))
        each = keyed.withColumn("places", places).select("*", F.size("places").alias("needed"), F.explode("places").alias("place"))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("place") % 64).cast("int"))
        return each.select("digest", "bucket", "needed", F.floor(F.col("place") / 64).cast("int").alias("word"), bit.alias("bit"))

    def _read(self, kind: str, schema: str, buckets: list[int], before: int) -> DataFrame:
        """The rows of ``kind`` that earlier batches wrote to ``buckets``; other buckets are not opened."""
        folder = self._folder(kind)
        there = set(child_names(self.spark, folder))
        paths = [f"{folder}/bucket={b}" for b in buckets if f"bucket={b}" in there]
        self.opened = self.opened._replace(**{kind: len(paths)})
        if not paths:
            return self.spark.createDataFrame([], f"{schema}, bucket int")
        reader = self.spark.read.schema(f"{schema}, bucket int, batch long").option("basePath", folder)
        return reader.parquet(*paths).where(F.col("batch") < before).drop("batch")

    def _numbers(self, keyed: DataFrame) -> dict[int, int]:
        """How many keys each bucket has in ``keyed``: at most ``MAX_BUCKETS`` numbers."""
        return {row["bucket"]: row["n"] for row in keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}

    def _small(self, rows: DataFrame, size: int) -> DataFrame:
        """``rows``, marked for broadcast if ``size`` bytes, a bound on theirs, allow it."""
        return F.broadcast(rows) if size <= broadcast_limit(self.spark) else rows

    def _seen(self, arrived: DataFrame, numbers: dict[int, int], batch: int) -> DataFrame | None:
        """The digests of ``arrived`` that an earlier batch added; None if no filter lets any pass."""
        self.opened = Opened(0, 0)
        filters = self._read("filters", _FILTER, list(numbers), batch)
        if not self.opened.filters:
            return None
        size = sum(numbers.values()) * KEY_BYTES * HASHES
        # Filters are scanned where they lie; a key passes whose every bit some batch has set.
        tested = filters.join(self._small(self._bits(arrived), size), ["bucket", "word"])
        set_bits = tested.where(F.col("bits").bitwiseAND(F.col("bit")) != 0).groupBy("digest", "bucket", "needed").agg(
            F.count_distinct("word", "bit").alias("n")
        )
        maybe = materialise(set_bits.where("n = needed").select("digest", "bucket"), "maybe-seen")
        asked = self._numbers(maybe)
        if not asked:
            return None
        known = self._read("keys", _KEYS, list(asked), batch).select("digest")
        # The few keys that may be known go to the opened buckets, which are scanned where they lie.
        found = known.join(self._small(maybe.select("digest"), sum(asked.values()) * KEY_BYTES), "digest", "left_semi")
        return materialise(found.distinct(), "seen")

    def unseen(self, rows: DataFrame, keys: list[str], batch: int) -> DataFrame:
        """The ``rows`` whose ``keys`` no earlier batch brought; their keys are added to the state.

        Rows of the batch that share a key all stay. Wide rows stay in place while the seen digests fit a broadcast and
        meet them by ``lookup_join`` beyond. Null keys are keys like any other.
        """
        if batch - self.upto > self.compact_every:
            self.compact(batch)
        keyed = rows.withColumn("_digest", key_digest(*keys))
        arrived = keyed.select(F.col("_digest").alias("digest")).distinct()
        arrived = materialise(arrived.withColumn("bucket", self._bucket()), "arrived")
        numbers = self._numbers(arrived)
        seen = self._seen(arrived, numbers, batch)
        if seen is None:
            self._write(arrived, self.generation, batch)
            return rows
        size = sum(numbers.values()) * KEY_BYTES
        self._write(arrived.join(self._small(seen, size), "digest", "left_anti"), self.generation, batch)
        gone = seen.select(F.col("digest").alias("_digest"))
        if size <= broadcast_limit(self.spark):
            return keyed.join(F.broadcast(gone), "_digest", "left_anti").drop("_digest")
        return lookup_join(keyed, gone, ["_digest"], "left_anti").drop("_digest")

    def _write(self, keyed: DataFrame, generation: int, batch: int) -> None:
        """Write keys before their filters: a filter never names a key that is not there."""
        filters = self._bits(keyed).groupBy("bucket", "word").agg(F.bit_or("bit").alias("bits"))
        for kind, rows in (("keys", keyed), ("filters", filters)):
            numbered = rows.repartition("bucket").withColumn("batch", F.lit(batch).cast("long"))
            numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                "bucket", "batch"
            ).parquet(self._folder(kind, generation))

    def compact(self, before: int) -> None:
        """Write what batches below ``before`` added as a generation of its own and go on from there.

        The generation counts once its row is written; a try that failed is written over. The one before the last is
        deleted.
        """
        folder = self._folder("keys")
        keys = self.spark.createDataFrame([], _KEYS)
        if path_exists(self.spark, folder):
            rows = self.spark.read.schema(f"{_KEYS}, bucket int, batch long").option("basePath", folder).parquet(folder)
            keys = rows.where(F.col("batch") < before).select("digest")
        buckets = max(self.buckets, min(MAX_BUCKETS, -(-keys.count() // self.bucket_keys)))
        following, upto = self.generation + 1, before - 1
        drop_path(self.spark, f"{self.path}/gen={following}")
        self._write(keys.withColumn("bucket", self._bucket(buckets)), following, upto)
        row = self.spark.createDataFrame([(following, buckets, upto)], "generation int, buckets int, upto long")
        row.write.mode("append").parquet(f"{self.path}/generations")
        drop_path(self.spark, f"{self.path}/gen={self.generation - 1}")
        self.generation, self.buckets, self.upto = following, buckets, upto
