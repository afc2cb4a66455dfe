"""Dashboard measures by hour (or day) and plant.

Each family of measures is one wide aggregate; a single measure selects from it, and Catalyst drops the
aggregates and scan columns nobody selected. A dashboard that wants several thus pays for one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.functions import exact_mean, exact_percentage, exact_sum, wall_clock
from sunledger.operators.yields import DAY, HOUR
from sunledger.schemas import EVENT_TIME, PLANT

WINDOW_KEY = ["window", PLANT]


def generator_by_window(readings: DataFrame, width: str = HOUR) -> DataFrame:
    return readings.groupBy(F.window(EVENT_TIME, width).alias("window"), PLANT).agg(
        exact_sum("DAILY_YIELD").alias("production"),
        exact_mean("DC_POWER").alias("avg_dc_power"),
        exact_mean("AC_POWER").alias("avg_ac_power"),
        exact_percentage("AC_POWER", "DC_POWER").alias("efficiency_pct"),
    )


def weather_by_window(readings: DataFrame, width: str = HOUR) -> DataFrame:
    return readings.groupBy(F.window(EVENT_TIME, width).alias("window"), PLANT).agg(
        exact_mean("IRRADIATION").alias("avg_irradiation"),
        exact_mean("MODULE_TEMPERATURE - AMBIENT_TEMPERATURE").alias("temperature_delta"),
    )


def by_hour(windows: DataFrame, *measures: str | Column) -> DataFrame:
    return windows.select(
        wall_clock("window.start").alias("hour_start"), F.col(PLANT).alias("plant_id"), *measures
    )


def hourly_avg_irradiation(weather: DataFrame) -> DataFrame:
    return by_hour(weather_by_window(weather), "avg_irradiation")


def temperature_delta(weather: DataFrame) -> DataFrame:
    return by_hour(weather_by_window(weather), "temperature_delta")


def avg_dc_power(generator: DataFrame) -> DataFrame:
    return by_hour(generator_by_window(generator), "avg_dc_power")


def avg_ac_power(generator: DataFrame) -> DataFrame:
    return by_hour(generator_by_window(generator), "avg_ac_power")


def conversion_efficiency(generator: DataFrame) -> DataFrame:
    """Ratio of sums, in percent; NULL where no DC power came in (nights)."""
    return by_hour(generator_by_window(generator), "efficiency_pct")


def one_capacity_per_plant(capacity: DataFrame) -> DataFrame:
    """Repeated rows of a plant count once; a plant with two different capacities stops the job."""
    low, high = F.min("capacity_kw"), F.max("capacity_kw")
    differs = F.concat(F.lit("two capacities for plant "), F.col("plant_id").cast("string"))
    checked = capacity.groupBy("plant_id").agg(low.alias("low"), high.alias("capacity_kw"))
    value = F.when(F.col("low") < F.col("capacity_kw"), F.raise_error(differs).cast("double")).otherwise(F.col("capacity_kw"))
    return checked.select("plant_id", value.alias("capacity_kw"))


def with_density(hours: DataFrame, capacity: DataFrame) -> DataFrame:
    """Production per unit of capacity; ``capacity`` has ``plant_id, capacity_kw``, one capacity per plant.

    No broadcast is forced: the optimizer broadcasts ``capacity`` when its size is under the threshold, and
    AQE decides again from the measured size. A plant without a known capacity keeps its row, with NULL.
    """
    density = F.try_divide("production", F.col("capacity_kw").cast("double"))
    kept = [name for name in hours.columns if name != "production"]
    joined = hours.join(one_capacity_per_plant(capacity), "plant_id", "left")
    return joined.select(*kept, density.alias("production_density"))


def hourly_production_density(generator: DataFrame, capacity: DataFrame) -> DataFrame:
    return with_density(by_hour(generator_by_window(generator), "production"), capacity)


def daily_production(generator: DataFrame) -> DataFrame:
    windows = generator_by_window(generator, DAY)
    return windows.select(
        wall_clock("window.start").alias("day_start"), F.col(PLANT).alias("plant_id"), "production"
    )


def daily_production_from_yield(daily_yield: DataFrame) -> DataFrame:
    """The same from the stored daily_yield table, which is smaller than the readings by far."""
    return daily_yield.groupBy(F.col("date_time").alias("day_start"), "plant_id").agg(
        exact_sum("rolling_sum").alias("production")
    )


def generator_weather_join(generator: DataFrame, weather: DataFrame) -> DataFrame:
    """Hourly DC power next to the hourly module-to-ambient difference; hours without weather keep NULL.

    Both sides are aggregated first, so the join sees one row per window and plant on either side, and it
    joins on the grouping keys as they are, so both exchanges are reused. On streams the window column
    carries the watermark that closes the outer join.
    """
    left = generator_by_window(generator).select(*WINDOW_KEY, "avg_dc_power")
    right = weather_by_window(weather).select(*WINDOW_KEY, "temperature_delta")
    return by_hour(left.join(right, WINDOW_KEY, "left"), "avg_dc_power", "temperature_delta")


def dashboard(generator: DataFrame, weather: DataFrame, capacity: DataFrame) -> DataFrame:
    """All hourly measures side by side, from one pass over each table. An hour that only one side has is there, with
    NULL for the other's measures: no reading from any inverter is what an outage looks like."""
    joined = generator_by_window(generator).join(weather_by_window(weather), WINDOW_KEY, "full")
    measures = ("production", "avg_irradiation", "avg_dc_power", "avg_ac_power", "temperature_delta", "efficiency_pct")
    return with_density(by_hour(joined, *measures), capacity)


def alerts(measures: DataFrame, measure: str, below: float | None = None, above: float | None = None) -> DataFrame:
    """Rows whose measure is under ``below`` or over ``above``. NULL measures raise no alert."""
    limits = []
    if below is not None:
        limits.append(F.col(measure) < F.lit(float(below)))
    if above is not None:
        limits.append(F.col(measure) > F.lit(float(above)))
    if not limits:
        raise ValueError("give a threshold: below, above or both")
    return measures.filter(limits[0] if len(limits) == 1 else limits[0] | limits[1])
