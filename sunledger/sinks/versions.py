"""All four tables replaced at once: versions in folders of their own, behind one pointer.

A load writes a whole new version beside the one that is read. Only when it is complete does the pointer, a small file
whose replacement is one atomic rename, name the new version. A load that stops anywhere before leaves readers with the
tables they had; what it wrote is an unnamed folder that :func:`drop_unnamed` removes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.schemas import TABLES, TableSpec
from sunledger.session import path_exists
from sunledger.sinks import tables

POINTER = "CURRENT"
FOLDER = "version="


def _file_system(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, root: str) -> str | None:
    """The folder that the pointer names, none before the first switch."""
    if not path_exists(spark, f"{root}/{POINTER}"):
        return None
    return f"{root}/{spark.read.text(f'{root}/{POINTER}').first()[0]}"


def switch(spark: SparkSession, root: str, version: str) -> None:
    """From now on readers find ``version``, a folder under ``root``. One rename: they see the old name or the new."""
    name = version.removeprefix(f"{root}/")
    if not path_exists(spark, f"{root}/{name}"):
        raise ValueError(f"{root} has no {name}")
    jvm = spark._jvm
    draft, fs = _file_system(spark, f"{root}/{POINTER}-{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(f"{name}\n".encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration())
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(draft, jvm.org.apache.hadoop.fs.Path(f"{root}/{POINTER}"), options)


def new_version(root: str) -> str:
    return f"{root}/{FOLDER}{uuid.uuid4().hex}"


def replace_all(spark: SparkSession, root: str, write: Callable[[str], None]) -> str:
    """``write`` fills a new version's folder; then, and only then, it becomes the current one."""
    version = new_version(root)
    write(version)
    missing = [name for name in TABLES if not path_exists(spark, f"{version}/{name}")]
    if missing:
        raise ValueError(f"the new version lacks {', '.join(missing)}")
    switch(spark, root, version)
    return version


def reload_history(generator: DataFrame, weather: DataFrame, root: str) -> str:
    """:func:`sunledger.sinks.tables.load_history` for readers that must never see a half of it."""
    return replace_all(generator.sparkSession, root, lambda path: tables.load_history(generator, weather, path))


def reset_all(spark: SparkSession, root: str) -> str:
    """Four empty tables in place of the current ones, at once."""
    return replace_all(spark, root, lambda path: tables.create_tables(spark, path))


def read_current(spark: SparkSession, spec: TableSpec, root: str) -> DataFrame:
    """The table as the pointer has it now. A reader that started before a switch goes on with the old version's files."""
    version = current_version(spark, root)
    if version is None:
        raise ValueError(f"{root} has no current version")
    return tables.read_table(spark, spec, f"{version}/{spec.name}")


def drop_unnamed(spark: SparkSession, root: str, keep: list[str] | None = None) -> list[str]:
    """Remove the versions the pointer does not name, but those in ``keep``; no load may be running."""
    named = {current_version(spark, root), *(keep or [])}
    base, fs = _file_system(spark, root)
    gone = []
    for status in fs.listStatus(base):
        name = status.getPath().getName()
        if name.startswith(FOLDER) and f"{root}/{name}" not in named:
            fs.delete(status.getPath(), True)
            gone.append(f"{root}/{name}")
    return gone


# --- compaction: closed days of a table that streams filled in small files ---


def days_with_files(spark: SparkSession, path: str) -> dict[date, tuple[int, int]]:
    """How many files each day has and how many bytes in them, from the folder listing: one row per file, not per row."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(f"{path}/{tables.PARTITION}=*")
    day = F.to_date(F.regexp_extract("path", rf"{tables.PARTITION}=([0-9-]+)", 1))
    found = rows.filter(F.col("path").endswith(".parquet")).groupBy(day.alias("day"))
    sums = found.agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    return {r.day: (r.files, r.bytes) for r in sums.collect()}


def compact(spark: SparkSession, root: str, before: date, target_bytes: int = 128 << 20) -> str:
    """A new version of the four tables in which each closed day (earlier than ``before``) has files of about
    ``target_bytes``, ordered by time; open days are copied as they are. Rows are the same before, during and after: readers
    keep the old version until the switch. Streams that append must be stopped or write elsewhere meanwhile.
    """
    old = current_version(spark, root)
    if old is None:
        raise ValueError(f"{root} has no current version")
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    held = spark.conf.get(advisory)

    def write(path: str) -> None:
        for name, spec in TABLES.items():
            table = tables.read_table(spark, spec, f"{old}/{name}")
            closed = F.col(tables.PARTITION) < F.lit(before)
            tables.write_table(table.filter(closed), spec, f"{path}/{name}", mode="overwrite")
            tables.write_table(table.filter(~closed), spec, f"{path}/{name}", rebalance=False)

    # Shuffled rows are larger than their columns in a file; four times is what the tables' rows take.
    spark.conf.set(advisory, str(4 * target_bytes))
    try:
        return replace_all(spark, root, write)
    finally:
        spark.conf.set(advisory, held)
