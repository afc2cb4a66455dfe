"""Alerts that go together: one row from the hour that raises to the hour that clears."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sunledger.functions import wall_clock
from sunledger.operators.yields import HOUR
from sunledger.schemas import PLANT


def alert_episodes(measures: DataFrame, measure: str, below: float, clear: float | None = None, gap: str = HOUR) -> DataFrame:
    """``plant_id, first_hour, last_hour, n_hours, worst`` of each episode, from hourly rows of a measure.

    An hour under ``below`` raises; the episode goes on through hours under ``clear`` (at least ``below``, and ``below`` if
    not given) and ends before the first hour that is not, or where the next hour known is more than ``gap`` later. NULLs
    are no hours. What one plant's window holds are its hours, not its readings.
    """
    clear = below if clear is None else clear
    if clear < below:
        raise ValueError("an alert clears at or above the value that raises it")
    by_time = Window.partitionBy("plant_id").orderBy("hour_start")
    far = F.col("hour_start") - F.lag("hour_start").over(by_time) > F.expr(f"interval {gap}")
    # A run starts after an hour that clears, after a gap, and with a plant's first hour.
    hours = measures.filter(F.col(measure).isNotNull()).select("plant_id", "hour_start", F.col(measure).alias("value"))
    calm = F.lag(F.col("value") >= F.lit(float(clear))).over(by_time)
    hours = hours.withColumn("starts", F.coalesce(calm | far, F.lit(True)))
    hours = hours.filter(F.col("value") < F.lit(float(clear)))
    runs = hours.withColumn("run", F.sum(F.col("starts").cast("int")).over(by_time))
    # Within a run the episode begins with the first hour that raises.
    in_run = Window.partitionBy("plant_id", "run").orderBy("hour_start")
    raised = F.max((F.col("value") < F.lit(float(below))).cast("int")).over(in_run)
    return (
        runs.withColumn("raised", raised)
        .filter("raised = 1")
        .groupBy("plant_id", "run")
        .agg(F.min("hour_start").alias("first_hour"), F.max("hour_start").alias("last_hour"), F.count("*").alias("n_hours"), F.min("value").alias("worst"))
        .drop("run")
    )


def alert_episodes_stream(windows: DataFrame, measure: str, below: float, gap: str = "61 minutes") -> DataFrame:
    """The streaming form, over hourly aggregates with their ``window`` column: hours under ``below`` in a row, as a
    session in the state until the watermark passes its end. ``gap`` is a little over the time from one hour to the next
    that still belongs to it."""
    low = windows.filter(F.col(measure) < F.lit(float(below)))
    # The last microsecond of the hour carries the watermark through the first aggregate.
    session = F.session_window(F.window_time("window"), gap)
    episodes = low.groupBy(session.alias("session"), PLANT).agg(
        F.min("window.start").alias("first"), F.max("window.start").alias("last"), F.count("*").alias("n_hours"), F.min(measure).alias("worst")
    )
    return episodes.select(
        F.col(PLANT).alias("plant_id"), wall_clock("first").alias("first_hour"), wall_clock("last").alias("last_hour"), "n_hours", "worst"
    )
