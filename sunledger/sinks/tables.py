"""Result tables as date-partitioned Parquet."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunledger.functions import wall_clock_literal, window_range
from sunledger.operators import yields
from sunledger.operators.keys import first_per_key, new_rows
from sunledger.operators.project import by_position
from sunledger.operators.results import tables_from_parts
from sunledger.schemas import (
    EVENT_TIME,
    GENERATOR_METRICS,
    HOURLY_PARTS,
    TABLES,
    WEATHER_METRICS,
    TableSpec,
    generator_schema,
    weather_schema,
)
from sunledger.session import new_run_dir, path_exists
from sunledger.sources.decode import decode_marked, split_marked

PARTITION = "event_date"
STREAM_LOG = "_spark_metadata"
#: In every file: the hour of a row, counted from 1970. Spark hands bounds on a whole number down to the row groups of a
#: file, and does not those on a zoneless time.
HOUR_NUMBER = "event_hour"
#: Rows lie by time within a file, so a range of time opens the row groups it needs; a file has several.
ROW_GROUP_BYTES = 16 << 20
#: A keyed append looks the batch's hours up as so many ranges of time at most; nearer ones are joined beyond that.
MOST_RANGES = 64
TimeRange = tuple[datetime, datetime]


def hour_number(time: Column) -> Column:
    return F.unix_date(F.to_date(time)) * 24 + F.hour(time)


def dated(rows: DataFrame, spec: TableSpec) -> DataFrame:
    time = F.col(spec.time_column)
    return rows.select(*spec.column_names, hour_number(time).alias(HOUR_NUMBER), F.to_date(time).alias(PARTITION))


def write_table(
    rows: DataFrame,
    spec: TableSpec,
    path: str,
    mode: str = "append",
    rebalance: bool = True,
    row_group_bytes: int = ROW_GROUP_BYTES,
) -> None:
    """Write rows into the table's columns, taken by name, one folder per day; :func:`insert_into` takes them by place.
    Each file is in order of time.

    ``rebalance`` gathers each day into files of AQE's advisory size: small days share no task with
    thousands of tiny files, and a day that holds a third of all rows is split. Turn it off for rows that
    already arrive by time, where each task holds few days and the shuffle would buy nothing.
    """
    if mode == "append" and path_exists(rows.sparkSession, f"{path}/{STREAM_LOG}"):
        raise ValueError(f"{path} belongs to a stream's file sink: readers would not see rows appended by others")
    out = dated(rows, spec)
    if rebalance:
        out = out.hint("rebalance", F.col(PARTITION))
    out = out.sortWithinPartitions(PARTITION, spec.time_column)
    writer = out.write.mode(mode).option("parquet.block.size", row_group_bytes)
    writer.partitionBy(PARTITION).parquet(path)


def insert_into(rows: DataFrame, spec: TableSpec, path: str) -> None:
    """INSERT INTO ... SELECT: the first column goes to the table's first, whatever either is called."""
    write_table(by_position(rows, spec), spec, path)


def staged(rows: DataFrame, path: str) -> DataFrame:
    """Rows written once and read back: what follows does not parse or sum them again."""
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def load_history(generator: DataFrame, weather: DataFrame, root: str) -> None:
    """All four tables under ``root`` from batch readings, in place of what was there, one row per key.

    Each input is read once and staged in the shared folder; the yields come from one pass over the staged readings,
    kept as the table ``hourly_parts`` beside the four. Sums count every message, repeated ones too; the tables of single
    readings hold each key once. A reading without an event time stops the load: split such rows off first
    (``decode_with_rejects``, ``csv_with_rejects``).
    """
    staging = new_run_dir(generator.sparkSession, "load")
    load_staged(staged(generator, f"{staging}/generator"), staged(weather, f"{staging}/weather"), root)


def load_staged(generator: DataFrame, weather: DataFrame, root: str) -> None:
    """:func:`load_history` from readings that can be read again at little cost, such as Parquet."""
    spark, path = generator.sparkSession, f"{root}/{HOURLY_PARTS.name}"
    for readings, spec in ((generator, GENERATOR_METRICS), (weather, WEATHER_METRICS)):
        if readings.filter(F.col(EVENT_TIME).isNull()).limit(1).count():
            raise ValueError(f"a row of {spec.name} without {spec.time_column}")
    write_table(yields.hourly_parts(generator), HOURLY_PARTS, path, mode="overwrite")
    parts = read_table(spark, HOURLY_PARTS, path)
    for name, rows in tables_from_parts(parts, generator, weather).items():
        spec = TABLES[name]
        if name in (GENERATOR_METRICS.name, WEATHER_METRICS.name):
            rows = first_per_key(rows, spec)
        write_table(rows, spec, f"{root}/{name}", mode="overwrite")


def load_messages(generator: DataFrame, weather: DataFrame, root: str) -> None:
    """:func:`load_history` from messages; those that are no reading go, with the reason, to ``generator_rejects`` and
    ``weather_rejects`` under ``root``. Each message is parsed once."""
    staging, readings = new_run_dir(generator.sparkSession, "load"), []
    for name, messages, schema in (("generator", generator, generator_schema()), ("weather", weather, weather_schema())):
        good, rejects = split_marked(staged(decode_marked(messages, schema), f"{staging}/{name}"))
        rejects.write.mode("overwrite").parquet(f"{root}/{name}_rejects")
        readings.append(good)
    load_staged(*readings, root)


def timed(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """The same rows; one without a time, which no day and no later check could find, stops the job."""
    time = F.col(spec.time_column)
    lost = F.raise_error(F.lit(f"a row of {spec.name} without {spec.time_column}")).cast(spec.schema[spec.time_column].dataType)
    return rows.withColumn(spec.time_column, F.coalesce(time, lost))


def create_table(spark: SparkSession, spec: TableSpec, path: str) -> None:
    """An empty table; also the reset of a filled one."""
    write_table(spark.createDataFrame([], spec.schema), spec, path, mode="overwrite", rebalance=False)


def create_tables(spark: SparkSession, root: str) -> None:
    for name, spec in TABLES.items():
        create_table(spark, spec, f"{root}/{name}")


def read_table(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    return spark.read.schema(T.StructType([*spec.schema, T.StructField(PARTITION, T.DateType())])).parquet(path)


def read_slice(spark: SparkSession, spec: TableSpec, path: str, start: datetime, end: datetime) -> DataFrame:
    """Rows with ``start <= time < end``, from the days' folders and the hours' row groups they are in."""
    return read_ranges(spark, spec, path, [(start, end)])


def read_windows(
    spark: SparkSession, spec: TableSpec, path: str, start: datetime, end: datetime, width: timedelta
) -> DataFrame:
    """The readings that windows with ``start <= window start < end`` are made of, pruned as :func:`read_slice`."""
    return read_slice(spark, spec, path, *window_range(start, end, width))


def append_new_rows(batch: DataFrame, spec: TableSpec, path: str) -> None:
    """Keyed append: rows whose key the table holds are left out, so a replayed batch adds nothing.

    Only the stored hours that the batch has rows of are looked up: files lie by day and in order of time, so a batch of
    one minute opens the row groups of one hour, however full the day is. The hours come to the driver, one value for
    each; the keys themselves stay on the executors. A row without a time stops the append.
    """
    batch = batch.select(*spec.column_names).persist()
    try:
        ranges = touched_ranges(batch, spec)
        if not ranges:
            return
        stored = read_ranges(batch.sparkSession, spec, path, ranges)
        write_table(new_rows(batch, stored, spec), spec, path)
    finally:
        batch.unpersist()


def read_ranges(spark: SparkSession, spec: TableSpec, path: str, ranges: list[TimeRange]) -> DataFrame:
    """Rows in any of some ranges of time (ends excluded). The days of each prune folders, its hours prune row groups:
    bounds on the time alone would open every file of the table."""
    fields = [T.StructField(HOUR_NUMBER, T.IntegerType()), T.StructField(PARTITION, T.DateType())]
    table = spark.read.schema(T.StructType([*spec.schema, *fields])).parquet(path)
    within = [
        F.col(PARTITION).between(F.lit(a.date()), F.lit(_last(b).date()))
        & F.col(HOUR_NUMBER).between(_hours(a), _hours(_last(b)))
        & (F.col(spec.time_column) >= wall_clock_literal(a))
        & (F.col(spec.time_column) < wall_clock_literal(b))
        for a, b in ranges
    ]
    return table.filter(reduce(or_, within, F.lit(False))).select(*spec.column_names)


def _last(end: datetime) -> datetime:
    """The last moment before an end."""
    return end - timedelta(microseconds=1)


def _hours(when: datetime) -> int:
    return (when - datetime(1970, 1, 1)) // timedelta(hours=1)


def touched_ranges(batch: DataFrame, spec: TableSpec, most: int = MOST_RANGES) -> list[TimeRange]:
    """The hours a batch has rows of, hours in a row as one range, in order. Of more than ``most`` ranges those with the
    shortest gaps are joined: what is looked up only grows. The hours grow with the time the batch spans at most, not
    with its rows."""
    t = f"`{spec.time_column}`"
    hour = F.expr(f"make_timestamp_ntz(year({t}), month({t}), day({t}), hour({t}), 0, 0)")
    hours = [row[0] for row in batch.select(hour.alias("hour")).distinct().collect()]
    if None in hours:
        raise ValueError(f"a row of {spec.name} without {spec.time_column}")
    return joined_ranges([(h, h + timedelta(hours=1)) for h in sorted(hours)], most)


def joined_ranges(ranges: list[TimeRange], most: int = MOST_RANGES) -> list[TimeRange]:
    """Ranges in order, those that touch as one, and no more than ``most`` of them."""
    gaps = sorted((b[0] - a[1] for a, b in zip(ranges, ranges[1:])), reverse=True)
    bridged = max([timedelta(0), *gaps[most - 1 : most]])
    out: list[TimeRange] = []
    for start, end in ranges:
        if out and start - out[-1][1] <= bridged:
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out
