"""Event-time slots: lookup, bounds, counts and gaps."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sunledger.functions import wall_clock_literal
from sunledger.schemas import EVENT_TIME, PLANT, SLOT

RUN = 96


def slot_lookup(readings: DataFrame, slot: datetime | None) -> DataFrame:
    """The readings of one slot, none when it is empty."""
    return readings.filter(F.col(EVENT_TIME) == wall_clock_literal(slot))


def first_slot(readings: DataFrame) -> datetime | None:
    """The earliest event time: one value, brought to the driver. As a literal it prunes the scan of the next
    query down to the row groups that hold it, which a scalar subquery does not."""
    return readings.agg(F.min(EVENT_TIME)).first()[0]


def slot_bounds(readings: DataFrame) -> DataFrame:
    return readings.groupBy(F.col(PLANT).alias("plant_id")).agg(
        F.min(EVENT_TIME).alias("first_slot"), F.max(EVENT_TIME).alias("last_slot")
    )


def rows_per_slot(readings: DataFrame) -> DataFrame:
    return readings.groupBy(F.col(EVENT_TIME).alias("date_time")).agg(F.count("*").alias("n_rows"))


def slots_with_readings(readings: DataFrame, step: str = SLOT) -> DataFrame:
    """Distinct (plant, slot). Map tasks drop repeats before the exchange."""
    slot = F.window(EVENT_TIME, step)["start"].alias("slot_start")
    return readings.select(F.col(PLANT).alias("plant_id"), slot).distinct()


def slot_gaps(readings: DataFrame, step: str = SLOT) -> DataFrame:
    """Slots of a plant's own time range that hold no reading.

    One scan: the distinct slots of a plant are put in order and only the holes between neighbours are
    spelled out. A plant's slots grow with its time range, not with its rows, so ordering them is one
    task's work per plant. A hole is spelled out in runs of slots first and then in slots, to keep arrays
    short.
    """
    every = F.expr(f"interval {step}")
    run = every * F.lit(RUN)
    by_time = Window.partitionBy("plant_id").orderBy("slot_start")
    holes = (
        slots_with_readings(readings, step)
        .withColumn("last", F.lead("slot_start").over(by_time) - every)
        .filter(F.col("last") > F.col("slot_start"))
        .select("plant_id", "last", F.explode(F.sequence(F.col("slot_start") + every, "last", run)).alias("from_slot"))
    )
    up_to = F.least(F.col("from_slot") + run - every, "last")
    return holes.select("plant_id", F.explode(F.sequence("from_slot", up_to, every)).alias("slot_start"))
