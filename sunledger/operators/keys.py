"""The primary-key contract of the result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sunledger.schemas import EVENT_TIME, PLANT, SOURCE, TableSpec


def duplicate_keys(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count. Only the key columns are read and shuffled."""
    return rows.groupBy(*key).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def first_per_key(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per key: the smallest of its rows, always the same one, whatever order they came in.

    Keys are counted by hash, map-side. Only rows whose key occurs more than once are put in order, and of those a map
    task keeps one per key before they are shuffled, so a key with very many copies is small by then.
    """
    key, rest = list(spec.key), [name for name in spec.column_names if name not in spec.key]
    repeated = duplicate_keys(rows, key).select(*(F.col(k).alias(f"repeated_{k}") for k in key))
    same_key = [F.col(k).eqNullSafe(F.col(f"repeated_{k}")) for k in key]
    order = Window.partitionBy(*key).orderBy(*rest)
    first = rows.join(repeated, same_key, "left_semi").withColumn("place", F.row_number().over(order))
    first = first.filter("place = 1").select(*spec.column_names)
    return rows.join(repeated, same_key, "left_anti").select(*spec.column_names).unionByName(first)


def new_rows(batch: DataFrame, stored_keys: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per key of ``batch`` that the table does not hold yet: writing them twice changes nothing. Stored keys
    go out first, so that a replay has nothing left to put in order."""
    stored = stored_keys.select(*(F.col(k).alias(f"stored_{k}") for k in spec.key))
    same_key = [F.col(k).eqNullSafe(F.col(f"stored_{k}")) for k in spec.key]
    return first_per_key(batch.join(stored, same_key, "left_anti"), spec)


def first_readings(readings: DataFrame, spread: int = 8) -> DataFrame:
    """Streaming form, on watermarked readings: drops repeats that arrive within the watermark delay of each
    other.

    State is kept per key until the watermark passes it. A key with very many copies would go to one task, so
    copies are thinned out over ``spread`` tasks first, by the partition they came in, and then per key. Where
    copies are rare, 1 saves the second state store.
    """
    key = [PLANT, SOURCE, EVENT_TIME]
    if spread > 1:
        share = F.pmod(F.spark_partition_id(), F.lit(spread))
        readings = readings.withColumn("share", share).dropDuplicatesWithinWatermark([*key, "share"]).drop("share")
    return readings.dropDuplicatesWithinWatermark(key)
