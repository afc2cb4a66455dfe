"""Event-time text formats and the zoneless edge type."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: time formats on the wire and in the CSV files ---
WIRE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DECODE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSS]"
CSV_TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss", "dd-MM-yyyy HH:mm", "yyyy-MM-dd'T'HH:mm:ss")
# --- end of fixed values ---


def parse_time(text: str | Column, formats: tuple[str, ...] = CSV_TIME_FORMATS) -> Column:
    """The first format that fits; NULL when none does."""
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in formats))


def window_range(start: datetime, end: datetime, width: timedelta) -> tuple[datetime, datetime]:
    """Event times of the tumbling windows that begin in ``[start, end)``: both bounds moved up to a window's start.
    Windows are counted from 1970, as window() does."""
    zero = datetime(1970, 1, 1)

    def up(when: datetime) -> datetime:
        return zero - (zero - when) // width * width

    return up(start), up(end)


def wire_time(ts: str | Column) -> Column:
    return F.date_format(ts, WIRE_TIME_FORMAT)


def wall_clock(ts: str | Column) -> Column:
    """Result times carry no zone. A no-op on batch times, a cast on a stream's (the session is UTC)."""
    return (F.col(ts) if isinstance(ts, str) else ts).cast("timestamp_ntz")


def wall_clock_literal(when: datetime | None) -> Column:
    """A zoneless literal. Goes through text: a plain literal would take the driver machine's zone into account."""
    return F.lit(None if when is None else str(when)).cast("timestamp_ntz")
