"""JSON messages to typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunledger.functions.times import DECODE_TIME_FORMAT
from sunledger.schemas import EVENT_TIME

CORRUPT = "_corrupt_record"
TIME_OPTIONS = {"timestampFormat": DECODE_TIME_FORMAT, "timestampNTZFormat": DECODE_TIME_FORMAT}


def finite_columns(schema: T.StructType) -> list[Column]:
    """NaN and infinities become NULL: neither has an exact sum. (NaN sorts above infinity in Spark.)"""
    return [
        F.when(F.abs(f.name) < F.lit(float("inf")), F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, T.DoubleType)
        else F.col(f.name)
        for f in schema
    ]


def _parsed(messages: DataFrame, schema: T.StructType, mode: str, extra: Sequence[str] = ()) -> DataFrame:
    # inline() is a generator: later filters stay above it, so each message is parsed once.
    body = F.from_json(F.col("value").cast("string"), schema, {"mode": mode, **TIME_OPTIONS})
    return messages.select(*extra, F.inline(F.array(body)))


def decode_json(
    messages: DataFrame, schema: T.StructType, mode: str = "FAILFAST", fields: Sequence[str] | None = None
) -> DataFrame:
    """Decode the ``value`` column. FAILFAST stops on a malformed message and on one without a value or an event time.
    PERMISSIVE nulls the bad fields and gives the messages that have a time; the others are those of
    :func:`decode_with_rejects`. Where the time is only text, every message is a row, with whatever time it has.

    ``fields`` names the ones the job uses: from_json parses all it is given, used or not.
    """
    if fields is not None:
        schema = T.StructType([schema[f] for f in fields])
    rows = _parsed(messages, schema, mode)
    time_type = schema[EVENT_TIME].dataType
    if isinstance(time_type, T.StringType):
        return rows.select(*finite_columns(schema))
    if mode == "FAILFAST":
        lost = F.raise_error(F.lit("a message without an event time")).cast(time_type)
        return rows.withColumn(EVENT_TIME, F.coalesce(EVENT_TIME, lost)).select(*finite_columns(schema))
    return rows.filter(F.col(EVENT_TIME).isNotNull()).select(*finite_columns(schema))


def decode_marked(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Every message, parsed once: its fields, and ``value, reject_reason`` where it gave no reading (NULL elsewhere)."""
    raw = messages.select(F.col("value").cast("string").alias("value"))
    with_text = T.StructType([*schema, T.StructField(CORRUPT, T.StringType())])
    rows = _parsed(raw, with_text, "PERMISSIVE", ["value"]).withColumn(
        "reject_reason",
        F.when(F.col("value").isNull(), "no value")
        .when(F.col(CORRUPT).isNotNull(), "malformed")
        .when(F.col(EVENT_TIME).isNull(), "no event time"),
    )
    value = F.when(F.col("reject_reason").isNotNull(), F.col("value")).alias("value")
    return rows.select(value, "reject_reason", *finite_columns(schema))


def split_marked(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readings, and ``(value, reject_reason)`` of the other messages."""
    good = marked.filter("reject_reason IS NULL").drop("value", "reject_reason")
    return good, marked.filter("reject_reason IS NOT NULL").select("value", "reject_reason")


def decode_with_rejects(messages: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Readings, and the messages that gave none: ``(value, reject_reason)``. Each message is in one of the two."""
    return split_marked(decode_marked(messages, schema))
