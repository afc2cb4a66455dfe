"""Session settings and the shared folder that streams and written tables use."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def configure(spark: SparkSession) -> SparkSession:
    """Pin what the results depend on.

    Event time is a zoneless wall clock, and window() aligns TIMESTAMP to the UTC epoch, so only a UTC
    session starts days at wall-clock midnight. AQE sizes and splits shuffle partitions at run time. Without ANSI
    mode a NaN would be summed as zero and an overflow wrap around.
    """
    spark.conf.set("spark.sql.ansi.enabled", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def require_utc(spark: SparkSession) -> None:
    """Zones with daylight saving lack or repeat wall-clock hours; what parses or prints times must not meet one."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"the session's time zone is {zone}, not UTC: call sunledger.session.configure first")


def configure_streams(spark: SparkSession, rocksdb: bool = True) -> SparkSession:
    """Settings of the streaming jobs, the same everywhere.

    Window state is kept in RocksDB: off the heap, and with only its changes uploaded per micro-batch. Small stores
    do not reserve disk ahead. Turned off, Spark's in-memory store stays as it is set.
    """
    configure(spark)
    if rocksdb:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    # A slow source must hold the watermark back, not lose its rows to a faster one.
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "min")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster it would be one machine's own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sunledger-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_run_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, pattern: str) -> bool:
    """Whether a path, or anything that fits a glob, is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0
