"""Session settings and shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

_ROCKSDB = "spark.sql.streaming.stateStore.rocksdb"
# Of the state's files the filters and indexes alone outgrow the default of 8 MB for each
# store, and are then read again for each lookup. Only what is in use is taken up.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    f"{_ROCKSDB}.blockCacheSizeMB": "128",
}
# Without the number of state rows in the progress, each write saves a read.
UNCOUNTED = {f"{_ROCKSDB}.trackTotalNumberOfRows": "false"}
# No batch after the last input, which ends what the watermark closes.
UNSETTLED = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}

# Settings that may change on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # transformWithState needs it; the other stateful operators profit from
    # state that lives outside the heap.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
}

# Settings that are fixed once a session runs.
STATIC_SETTINGS = {
    # Keeping a Python call site for every column expression makes building a
    # large plan several times slower.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "tillwater", master: str | None = None, **extra) -> SparkSession:
    """A session with the settings the library expects; `extra` wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**STATIC_SETTINGS, **RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session someone else built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written to the scratch space and read back, for use in several places."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for checkpoints and cut points.

    On a cluster it lies in the shared folder named by `spark.checkpoint.dir`;
    a machine-local folder is used only where that is unset and the session
    is a local one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or spark.sparkContext.getCheckpointDir()
    if shared:
        return f"{shared.rstrip('/')}/tillwater/{purpose}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return os.path.join(tempfile.mkdtemp(prefix="run-", dir="/tmp"), purpose)
