"""Keyed JSON messages to a topic in event-time order, to a stream's folder of files, or to text files in a dry run."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.operators.project import messages
from sunledger.schemas import EVENT_TIME, WATERMARK_DELAY
from sunledger.session import path_exists


def publish(readings: DataFrame, bootstrap: str, topic: str, staging: str, width: str = WATERMARK_DELAY) -> None:
    """All readings to a topic in event-time order: one slice of time after the other, each in one distributed write.

    The key decides the topic partition, so a source's readings stay together. Tasks of one write finish in any order, so
    within a slice order may be off by its width: with slices no wider than a consumer's watermark delay nothing comes
    late to it, wherever its triggers cut. A publish that was stopped goes on with the slice it was at.
    """
    options = {"kafka.bootstrap.servers": bootstrap, "topic": topic}
    stage_slices(readings, staging, width, keyed=True)
    spark = readings.sparkSession
    for name in staged_names(spark, staging):
        slice_ = spark.read.schema("key string, value string").parquet(f"{staging}/slice={name}")
        slice_.write.format("kafka").options(**options).save()
        _delete(spark, f"{staging}/slice={name}")


# --- slices of time ---


def in_slices(readings: DataFrame, width: str) -> DataFrame:
    """Messages with the ``slice`` of time they fall in, ranged by time over the tasks and in order within each. Beyond
    the time, source and content bound the ranges, so a source or a moment with very many readings is split."""
    name = F.date_format(F.window(EVENT_TIME, width)["start"], "yyyyMMdd'T'HHmmss").alias("slice")
    rows = messages(readings, name, F.col(EVENT_TIME).alias("at"))
    rows = rows.repartitionByRange("at", "key", F.xxhash64("value"))
    return rows.sortWithinPartitions("slice", "at", "key")


def stage_slices(readings: DataFrame, path: str, width: str, keyed: bool = False) -> None:
    """All messages in one distributed write, a folder for each slice: text files of the values, or with ``keyed`` Parquet
    of keys and values. The source is read for the bounds of the ranges and once more for the rows. A finished write is
    left as it is, so an interrupted replay goes on; an unfinished one is written anew."""
    if path_exists(readings.sparkSession, f"{path}/_SUCCESS"):
        return
    rows = in_slices(readings, width).select(*(["key"] if keyed else []), "value", "slice")
    rows.write.mode("overwrite").partitionBy("slice").format("parquet" if keyed else "text").save(path)


def staged_names(spark: SparkSession, path: str) -> list[str]:
    """The slices still staged, in order of time: one name each, they grow with the time range and not with the rows."""
    base, fs = _file_system(spark, path)
    names = [status.getPath().getName() for status in fs.listStatus(base)]
    return sorted(name.removeprefix("slice=") for name in names if name.startswith("slice="))


def publish_files(spark: SparkSession, staging: str, path: str, names: list[str] | None = None) -> None:
    """Staged slices to the folder a stream reads, in order: the file twin of a topic.

    A file stream takes files by their time of change. Each file is given one after all that are published, and then
    moved: it appears whole, and in its place. What is moved is not staged any more, so a publish that was stopped goes on.
    """
    target, fs = _file_system(spark, path)
    fs.mkdirs(target)
    clock = max([int(time.time() * 1000), *(s.getModificationTime() for s in fs.listStatus(target) if s.isFile())])
    for name in staged_names(spark, staging) if names is None else names:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{staging}/slice={name}")
        parts = {s.getPath().getName(): s.getPath() for s in fs.listStatus(folder)}
        for part in sorted(p for p in parts if p.startswith("part-")):
            clock += 1
            fs.setTimes(parts[part], clock, -1)
            if not fs.rename(parts[part], spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}-{part}")):
                raise OSError(f"{part} of {name} could not be published")
        fs.delete(folder, True)


def _file_system(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, path: str) -> None:
    found, fs = _file_system(spark, path)
    fs.delete(found, True)


def dry_run(readings: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write all messages as text instead of sending them, key and value with a tab between. The tasks write: nothing
    passes through the driver."""
    lines = messages(readings).select(F.concat_ws("\t", "key", "value").alias("line"))
    lines.write.mode(mode).text(path)


def preview(readings: DataFrame, rows: int = 20) -> None:
    """The first few messages, on the screen."""
    messages(readings).show(rows, truncate=False)


def write_messages(readings: DataFrame, path: str, mode: str = "append") -> None:
    """All message values as text files, one JSON object per line: what a stream of message files takes in. The values
    repeat the key's fields."""
    messages(readings).select("value").write.mode(mode).text(path)
