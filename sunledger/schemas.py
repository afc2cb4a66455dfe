"""Declared schemas: the two message kinds and the four result tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values: field names, types and order of the telemetry contract ---
EVENT_TIME = "DATE_TIME"
PLANT = "PLANT_ID"
SOURCE = "SOURCE_KEY"
GENERATOR_MEASURES = ("DC_POWER", "AC_POWER", "DAILY_YIELD", "TOTAL_YIELD")
WEATHER_MEASURES = ("AMBIENT_TEMPERATURE", "MODULE_TEMPERATURE", "IRRADIATION")
GENERATOR_TOPIC = "generator-topic"
WEATHER_TOPIC = "weather-topic"
GENERATOR_CSV = "Plant_{plant_id}_Generation_Data.csv"
WEATHER_CSV = "Plant_{plant_id}_Weather_Sensor_Data.csv"
SLOT = "15 minutes"
WATERMARK_DELAY = "30 minutes"
# --- end of fixed values ---


def message_schema(measures: tuple[str, ...], time_type: T.DataType) -> T.StructType:
    """One message: event time, the measures, then the key fields.

    ``time_type`` is TimestampNTZType in batch, TimestampType in a stream (a watermark needs it) and
    StringType for the raw reader, which keeps the time as it came.
    """
    schema = T.StructType().add(EVENT_TIME, time_type)
    for name in measures:
        schema = schema.add(name, T.DoubleType())
    return schema.add(PLANT, T.IntegerType()).add(SOURCE, T.StringType())


def generator_schema(time_type: T.DataType = T.TimestampNTZType()) -> T.StructType:
    return message_schema(GENERATOR_MEASURES, time_type)


def weather_schema(time_type: T.DataType = T.TimestampNTZType()) -> T.StructType:
    return message_schema(WEATHER_MEASURES, time_type)


@dataclass(frozen=True)
class TableSpec:
    """A result table: its columns in insert order, its key, and the time column it is partitioned on."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    time_column: str

    @property
    def column_names(self) -> list[str]:
        return self.schema.fieldNames()


def _columns(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


INT, TEXT, TIME, NUMBER = T.IntegerType(), T.StringType(), T.TimestampNTZType(), T.DoubleType()

# --- Fixed values: names, columns and keys of the result tables ---
SINK_SCHEMA = "solar"
DAILY_YIELD = TableSpec(
    "daily_yield",
    _columns(plant_id=INT, source_key=TEXT, date_time=TIME, rolling_sum=NUMBER),
    ("plant_id", "source_key", "date_time"),
    "date_time",
)
GENERATOR_METRICS = TableSpec(
    "generator_metrics",
    _columns(plant_id=INT, source_key=TEXT, date_time=TIME, dc_power=NUMBER, ac_power=NUMBER).add("yield", NUMBER),
    ("plant_id", "source_key", "date_time"),
    "date_time",
)
WEATHER_METRICS = TableSpec(
    "weather_metrics",
    _columns(
        plant_id=INT, source_key=TEXT, date_time=TIME, ambient_temp=NUMBER, module_temp=NUMBER, irradiation=NUMBER
    ),
    ("plant_id", "source_key", "date_time"),
    "date_time",
)
HOURLY_YIELD = TableSpec(
    "hourly_yield",
    _columns(window_start=TIME, window_end=TIME, plant_id=INT, source_key=TEXT, total_yield=NUMBER),
    ("window_start", "plant_id", "source_key"),
    "window_start",
)
# --- end of fixed values ---

#: Not one of the four: the hourly sums of DAILY_YIELD before rounding, as the parts that :mod:`sunledger.functions.exact` sums.
HOURLY_PARTS = TableSpec(
    "hourly_parts",
    _columns(window_start=TIME, plant_id=INT, source_key=TEXT, n_rows=T.LongType(), **{f"part_{i}": T.LongType() for i in range(6)}),
    ("window_start", "plant_id", "source_key"),
    "window_start",
)

TABLES = {spec.name: spec for spec in (DAILY_YIELD, GENERATOR_METRICS, WEATHER_METRICS, HOURLY_YIELD)}
