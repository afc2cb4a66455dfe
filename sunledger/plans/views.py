"""Generator and weather readings derived from an events table, in place of plant files.

``ts, user_id, event_type, value, props`` become readings of three plants: the event type stands for the
inverter, and the 'view' events also for the plant's weather sensor. As with messages, an event without a
time is no reading.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.functions import wall_clock_literal

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


# The start of a one-second window is the time cut to seconds, in plain long arithmetic; date_trunc would convert
# each zoneless time to an instant and back.
TIME = "cast(window(ts, '1 second').start as {time_type}) as DATE_TIME"
PLANT = "cast(user_id % 3 as int)"
LEVEL = "cast(get_json_object(props, '$.k') as int)"


def generator_readings(events: DataFrame, time_type: str = "timestamp_ntz") -> DataFrame:
    return events.selectExpr(
        TIME.format(time_type=time_type),
        "value as DC_POWER",
        f"value * (0.9e0 + {LEVEL} / 1000e0) as AC_POWER",
        "value as DAILY_YIELD",
        "value as TOTAL_YIELD",
        f"{PLANT} as PLANT_ID",
        "event_type as SOURCE_KEY",
    )


def weather_readings(events: DataFrame, time_type: str = "timestamp_ntz") -> DataFrame:
    return events.filter("event_type = 'view'").selectExpr(
        TIME.format(time_type=time_type),
        f"20e0 + {LEVEL} / 10e0 as AMBIENT_TEMPERATURE",
        f"20e0 + {LEVEL} / 10e0 + value / 10e0 as MODULE_TEMPERATURE",
        "value / 100e0 as IRRADIATION",
        f"{PLANT} as PLANT_ID",
        f"concat('sensor-', {PLANT}) as SOURCE_KEY",
    )


def events_between(events: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Bounds on the stored column itself, so that they reach the scan (whole seconds, end excluded)."""
    ts = F.col("ts")
    return events.filter((ts >= wall_clock_literal(start)) & (ts < wall_clock_literal(end)))
