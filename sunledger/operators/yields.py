"""Tumbling yield sums per plant and source. The same code serves a batch and a stream.

Map tasks sum before the exchange on (window, plant, source), so a source that sends a third of all rows
costs the shuffle one row per map task and window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.functions import exact_parts, exact_sum, merged_sum, parts_total, wall_clock
from sunledger.operators.project import key_columns
from sunledger.schemas import EVENT_TIME, HOURLY_PARTS, PLANT, SOURCE

HOUR = "1 hour"
DAY = "1 day"


def tumbling_sum(readings: DataFrame, width: str, measure: str = "DAILY_YIELD") -> DataFrame:
    """``window, PLANT_ID, SOURCE_KEY, total``. Every message counts, repeated ones too; rows without an
    event time fall in no window."""
    window = F.window(EVENT_TIME, width).alias("window")
    return readings.groupBy(window, PLANT, SOURCE).agg(exact_sum(measure).alias("total"))


def hourly_yield(readings: DataFrame) -> DataFrame:
    return tumbling_sum(readings, HOUR).select(
        wall_clock("window.start").alias("window_start"),
        wall_clock("window.end").alias("window_end"),
        *key_columns(),
        F.col("total").alias("total_yield"),
    )


def daily_yield(readings: DataFrame) -> DataFrame:
    """``rolling_sum`` is the table's name for it; the sum is a tumbling one, over one day."""
    return tumbling_sum(readings, DAY).select(
        *key_columns(),
        wall_clock("window.start").alias("date_time"),
        F.col("total").alias("rolling_sum"),
    )


# --- the same from stored parts: one pass over the readings, whatever the number of windows made of it ---


def hourly_parts(readings: DataFrame, measure: str = "DAILY_YIELD") -> DataFrame:
    """``hourly_parts`` rows: the hour's sum before rounding. Batch or (watermarked) stream."""
    window = F.window(EVENT_TIME, HOUR).alias("window")
    sums = readings.groupBy(window, PLANT, SOURCE).agg(F.count("*").alias("n_rows"), *exact_parts(measure))
    return sums.withColumn("window_start", wall_clock("window.start")).select(
        "window_start", *key_columns(), *HOURLY_PARTS.column_names[3:]
    )


def hourly_from_parts(parts: DataFrame) -> DataFrame:
    """hourly_yield, row by row: no exchange."""
    end = F.col("window_start") + F.expr(f"interval {HOUR}")
    return parts.select("window_start", end.alias("window_end"), "plant_id", "source_key", parts_total().alias("total_yield"))


def daily_from_parts(parts: DataFrame) -> DataFrame:
    """daily_yield: the hours' parts add up to the bits that the day's readings give."""
    day = F.window("window_start", DAY)
    days = parts.groupBy("plant_id", "source_key", day.alias("day")).agg(merged_sum().alias("rolling_sum"))
    return days.select("plant_id", "source_key", wall_clock("day.start").alias("date_time"), "rolling_sum")


def production_from_parts(parts: DataFrame, width: str = DAY, name: str = "day_start") -> DataFrame:
    """Production of each plant over windows of whole hours, from 1970 on."""
    window = F.window("window_start", width)
    sums = parts.groupBy(window.alias("window"), "plant_id").agg(merged_sum().alias("production"))
    return sums.select(wall_clock("window.start").alias(name), "plant_id", "production")
