"""The four result tables from readings, batch or stream."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sunledger.operators import project, yields
from sunledger.schemas import DAILY_YIELD, GENERATOR_METRICS, HOURLY_YIELD, WEATHER_METRICS


def result_tables(
    generator: DataFrame, weather: DataFrame, yield_readings: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Table name to rows. ``yield_readings`` may give the generator readings over again with no more than the
    fields the yield tables need, for sources that cannot be pruned later."""
    if yield_readings is None:
        yield_readings = generator
    return {
        DAILY_YIELD.name: yields.daily_yield(yield_readings),
        HOURLY_YIELD.name: yields.hourly_yield(yield_readings),
        GENERATOR_METRICS.name: project.generator_metrics(generator),
        WEATHER_METRICS.name: project.weather_metrics(weather),
    }


def tables_from_parts(parts: DataFrame, generator: DataFrame, weather: DataFrame) -> dict[str, DataFrame]:
    """The same from stored ``hourly_parts`` and readings."""
    return {
        DAILY_YIELD.name: yields.daily_from_parts(parts),
        HOURLY_YIELD.name: yields.hourly_from_parts(parts),
        GENERATOR_METRICS.name: project.generator_metrics(generator),
        WEATHER_METRICS.name: project.weather_metrics(weather),
    }
