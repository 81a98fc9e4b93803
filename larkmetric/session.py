"""Session settings and the shared scratch folder."""

from __future__ import annotations

import zlib

from pyspark.sql import SparkSession

# AQE picks join strategies and splits hot shuffle partitions from measured
# sizes. Splitting is allowed even where it costs one more shuffle: a join whose
# hot key holds a third of the rows is slower than that shuffle.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    # Call sites of every column expression cost more than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name: str = "larkmetric", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def allow_skew_split(spark: SparkSession) -> None:
    """In a session made elsewhere, let AQE split hot join keys as ours does."""
    key = "spark.sql.adaptive.forceOptimizeSkewedJoin"
    spark.conf.set(key, SETTINGS[key])


def scratch_dir(spark: SparkSession, name: str, sf_dir: str = "") -> str:
    """A folder for a query's own files under the session's shared storage.

    That is ``spark.checkpoint.dir``, else the warehouse: on a cluster all
    executors see both. The name depends on application, query and input only, so
    a query that runs again replaces its files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{zlib.crc32(sf_dir.encode()):08x}"
