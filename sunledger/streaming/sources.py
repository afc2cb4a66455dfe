"""Message streams to typed, watermarked readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sunledger.schemas import EVENT_TIME, WATERMARK_DELAY, generator_schema, weather_schema
from sunledger.session import require_utc
from sunledger.sources.decode import decode_json, decode_with_rejects


def watermarked(readings: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Rows up to ``delay`` behind the latest event time are always counted. Rows later than that may be left
    out of windows that have closed; Spark moves the watermark between micro-batches, not within."""
    require_utc(readings.sparkSession)
    return readings.withWatermark(EVENT_TIME, delay)


def generator_stream(messages: DataFrame, mode: str = "FAILFAST", fields: Sequence[str] | None = None) -> DataFrame:
    return watermarked(decode_json(messages, generator_schema(T.TimestampType()), mode, fields))


def weather_stream(messages: DataFrame, mode: str = "FAILFAST", fields: Sequence[str] | None = None) -> DataFrame:
    return watermarked(decode_json(messages, weather_schema(T.TimestampType()), mode, fields))


def with_rejects(messages: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Watermarked readings and the rejected messages, as two streams."""
    good, rejects = decode_with_rejects(messages, schema)
    return watermarked(good), rejects


def raw_generator_rows(messages: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """The time stays the text it came as."""
    return decode_json(messages, generator_schema(T.StringType()), mode)


def raw_weather_rows(messages: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    return decode_json(messages, weather_schema(T.StringType()), mode)
