"""Projections: readings to sink columns, readings to messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.functions import message_key, message_value, wall_clock
from sunledger.schemas import EVENT_TIME, PLANT, SOURCE, TableSpec
from sunledger.session import require_utc


def key_columns() -> list:
    return [F.col(PLANT).alias("plant_id"), F.col(SOURCE).alias("source_key")]


def generator_metrics(readings: DataFrame) -> DataFrame:
    return readings.select(
        *key_columns(),
        wall_clock(EVENT_TIME).alias("date_time"),
        F.col("DC_POWER").alias("dc_power"),
        F.col("AC_POWER").alias("ac_power"),
        F.col("DAILY_YIELD").alias("yield"),
    )


def weather_metrics(readings: DataFrame) -> DataFrame:
    return readings.select(
        *key_columns(),
        wall_clock(EVENT_TIME).alias("date_time"),
        F.col("AMBIENT_TEMPERATURE").alias("ambient_temp"),
        F.col("MODULE_TEMPERATURE").alias("module_temp"),
        F.col("IRRADIATION").alias("irradiation"),
    )


def generator_readings(table: DataFrame) -> DataFrame:
    """The stored generator_metrics under the names the measures use, so that dashboards can read the table."""
    return table.select(
        F.col("date_time").alias(EVENT_TIME),
        F.col("dc_power").alias("DC_POWER"),
        F.col("ac_power").alias("AC_POWER"),
        F.col("yield").alias("DAILY_YIELD"),
        F.col("plant_id").alias(PLANT),
        F.col("source_key").alias(SOURCE),
    )


def weather_readings(table: DataFrame) -> DataFrame:
    """The stored weather_metrics under the names the measures use."""
    return table.select(
        F.col("date_time").alias(EVENT_TIME),
        F.col("ambient_temp").alias("AMBIENT_TEMPERATURE"),
        F.col("module_temp").alias("MODULE_TEMPERATURE"),
        F.col("irradiation").alias("IRRADIATION"),
        F.col("plant_id").alias(PLANT),
        F.col("source_key").alias(SOURCE),
    )


def by_position(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """INSERT ... SELECT: the first column goes to the table's first, whatever either is called."""
    named = rows.toDF(*spec.column_names)
    return named.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema))


def messages(readings: DataFrame, *more: Column) -> DataFrame:
    """Keyed JSON messages, ready for a topic. All columns but time and key are measures, in their order. ``more`` adds
    columns beside key and value."""
    require_utc(readings.sparkSession)
    measures = [name for name in readings.columns if name not in (EVENT_TIME, PLANT, SOURCE)]
    return readings.select(message_key().alias("key"), message_value(measures).alias("value"), *more)
