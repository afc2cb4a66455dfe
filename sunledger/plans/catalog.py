"""SQL names for the streams and the result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sunledger.schemas import SINK_SCHEMA, TABLES
from sunledger.sinks.tables import read_table

GENERATOR_VIEW = "generator_metrics"
WEATHER_VIEW = "weather_metrics"


def register_sources(generator: DataFrame, weather: DataFrame) -> None:
    """``generator_metrics`` and ``weather_metrics``, for batch or streaming SQL with ``window()``."""
    generator.createOrReplaceTempView(GENERATOR_VIEW)
    weather.createOrReplaceTempView(WEATHER_VIEW)


def register_tables(spark: SparkSession, root: str) -> None:
    """``solar_daily_yield`` and so on, over the tables stored under ``root``."""
    for name, spec in TABLES.items():
        read_table(spark, spec, f"{root}/{name}").createOrReplaceTempView(f"{SINK_SCHEMA}_{name}")
