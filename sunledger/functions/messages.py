"""JSON key and value of a telemetry message."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sunledger.functions.times import wire_time
from sunledger.schemas import EVENT_TIME, PLANT, SOURCE

KEEP_NULLS = {"ignoreNullFields": "false"}


def message_key() -> Column:
    """``{"plant_id": .., "source_key": ..}``: readings of one source share a key, hence a topic partition."""
    return F.to_json(F.struct(F.col(PLANT).alias("plant_id"), F.col(SOURCE).alias("source_key")), KEEP_NULLS)


def message_value(measures: list[str]) -> Column:
    """Wire time, the measures, then the key fields again under their upper-case names."""
    fields = [wire_time(EVENT_TIME).alias(EVENT_TIME), *map(F.col, measures), F.col(PLANT), F.col(SOURCE)]
    return F.to_json(F.struct(*fields), KEEP_NULLS)
