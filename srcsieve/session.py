"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

_local_roots: dict[str, str] = {}


def build_session(app_name: str = "srcsieve", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on.

    ``maxRecordsPerBatch`` keeps Arrow batches of whole source files small. AQE is on, and
    its coalescing makes a high ``spark.sql.shuffle.partitions`` safe on a cluster.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A temporary folder is made only where the setting is absent and the master is local;
    on a cluster a machine-local folder would lose data with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = _local_roots.get(context.applicationId)
    if root is None:
        root = _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="srcsieve-")
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared scratch folder."""
    app = spark.sparkContext.applicationId
    return os.path.join(scratch_root(spark), f"srcsieve-{app}", f"{label}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage of ``df``: write it to the shared folder and read it back.

    A written table survives lost executors and can be re-read with column pruning.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of finished jobs, which else stay until the driver happens to collect its garbage."""
    gc.collect()
    spark._jvm.System.gc()


def _store(spark: SparkSession, path: str):
    """The store of ``path``, any that Spark reads, and the path in it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    store, target = _store(spark, path)
    return store.exists(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it is not there."""
    store, target = _store(spark, path)
    return [status.getPath().getName() for status in store.listStatus(target)] if store.exists(target) else []


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder if it is there."""
    store, target = _store(spark, path)
    store.delete(target, True)


def read_runs(spark: SparkSession, path: str, schema: str, before: int | None = None) -> DataFrame:
    """What runs wrote to ``path/run=N``, of those numbered below ``before`` if it is given; no rows if none did."""
    if not path_exists(spark, path):
        # No rows from a list: that would start Python workers to read none.
        return spark.range(0).select(F.from_json(F.lit(None).cast("string"), schema).alias("_row")).select("_row.*")
    rows = spark.read.schema(f"{schema}, run long").option("basePath", path).parquet(path)
    return (rows if before is None else rows.where(f"run < {before}")).drop("run")


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to the scratch folder.

    For the end of a job: results that are read from scratch tables must be written first.
    """
    drop_path(spark, os.path.join(scratch_root(spark), f"srcsieve-{spark.sparkContext.applicationId}"))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, for clusters where it is not installed."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="srcsieve-zip-"), "srcsieve")
    archive = shutil.make_archive(target, "zip", os.path.dirname(package), os.path.basename(package))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
