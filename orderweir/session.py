"""Session settings the library relies on, and where it may write."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings that change results or plans; safe to set on a live session.
RUNTIME_SETTINGS = {
    # Date casts and epoch values follow the session zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys are split at run time, also when that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Join by hash instead of sorting where every partition of the smaller side is small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # The driver keeps a text of every plan and renews it after each stage: the short form.
    "spark.sql.ui.explainMode": "simple",
    # Stream state on local disk with incremental checkpoints, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

def build_session(app: str = "orderweir", master: str | None = None, **settings) -> SparkSession:
    """A session with the library's settings; the master comes from spark-submit when not given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder that all executors share: `spark.checkpoint.dir`, else the warehouse's.

    On a cluster a warehouse on the machines' own disks is refused: each executor would write to its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if warehouse.startswith("file:") and not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; {warehouse} is not one")
        base = warehouse.rstrip("/") + "/_shared"
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


# Drops a query's shuffle files when it ends; sessions that do not know it keep them until the driver collects garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The disk that a query inside took for its shuffles is free as soon as the query ends: for writes, which run once."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def stored(df: DataFrame | Sequence[DataFrame], purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: later steps do not compute it again.

    Several frames of the same columns are written one after the other, so that disk holds the shuffles of one at a time.
    """
    parts = [df] if isinstance(df, DataFrame) else df
    return _stored_at(shared_dir(parts[0].sparkSession, purpose), parts)


@contextmanager
def stored_meanwhile(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """`stored`, for a large frame that is needed inside only: what was written is deleted at the end."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    try:
        yield _stored_at(path, [df])
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _stored_at(path: str, parts: Sequence[DataFrame]) -> DataFrame:
    df = parts[0]
    for part in parts:
        with shuffles_dropped(df.sparkSession):
            part.write.mode("append").option("compression", "zstd").parquet(path)
    # With its schema at hand no job is run to find it out.
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let the driver collect its garbage, after a step of many small jobs.

    Spark drops the shuffle files and broadcasts of finished jobs only when the driver collects, and a heap that is left
    to grow until then keeps its size.
    """
    spark.sparkContext._jvm.System.gc()
