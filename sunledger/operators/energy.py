"""Energy from the inverters' daily counters.

DAILY_YIELD counts up from midnight. Its sum over an hour grows with how often it is reported; the energy of an hour is how
far the counter went.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sunledger.functions import exact_sum, wall_clock
from sunledger.operators.project import key_columns
from sunledger.operators.yields import DAY, HOUR
from sunledger.schemas import EVENT_TIME, PLANT, SOURCE


def counter_steps(readings: DataFrame, counter: str = "DAILY_YIELD") -> DataFrame:
    """``PLANT_ID, SOURCE_KEY, DATE_TIME, step``: how far the counter went since the source's last reading of the day.

    Readings of one source and time count once, at the largest. The first reading of a day and one after the counter
    fell (a reset) step from zero. NULLs are no readings. A source's day is put in order by itself, after repeats are dropped
    map-side, so neither a long history nor a source that reports a third of all rows comes together in one task.
    """
    key = [PLANT, SOURCE, EVENT_TIME]
    once = readings.filter(F.col(counter).isNotNull()).groupBy(*key).agg(F.max(counter).alias("counter"))
    day = F.window(EVENT_TIME, DAY)["start"]
    before = F.lag("counter").over(Window.partitionBy(PLANT, SOURCE, "day").orderBy(EVENT_TIME))
    steps = once.withColumn("day", day).withColumn("before", before)
    fresh = F.col("before").isNull() | (F.col("counter") < F.col("before"))
    return steps.select(*key, F.when(fresh, F.col("counter")).otherwise(F.col("counter") - F.col("before")).alias("step"))


def hourly_energy(readings: DataFrame, width: str = HOUR) -> DataFrame:
    """``window_start, plant_id, source_key, energy``: the steps that end in the hour."""
    window = F.window(EVENT_TIME, width).alias("window")
    sums = counter_steps(readings).groupBy(window, PLANT, SOURCE).agg(exact_sum("step").alias("energy"))
    return sums.select(wall_clock("window.start").alias("window_start"), *key_columns(), "energy")
