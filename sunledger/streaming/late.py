"""Readings that came after their window had closed, as a table of their own.

Spark drops late rows within the window sum, counts them after the map-side sum, and lets some through: it compares them
with the watermark of the micro-batch before. Here each reading is compared with its batch's watermark before any sum: the
latest event time of all batches before, less the delay. Late readings go to one table, all others to another, and sums
that stream from the other drop nothing: every reading is counted, late, or in a window still open.

Each batch writes both sides and the latest time so far under its own number. What a batch that runs twice finds finished
it leaves as it is, so nobody downstream sees a reading twice.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sunledger.functions import wall_clock
from sunledger.operators.yields import HOUR
from sunledger.schemas import EVENT_TIME, WATERMARK_DELAY
from sunledger.session import path_exists
from sunledger.streaming.jobs import start_batches
from sunledger.streaming.sources import watermarked

SEEN = "latest timestamp_ntz, n_rows bigint, n_late bigint"


def _seen(spark: SparkSession, path: str, batch: int) -> datetime | None:
    """The latest event time of the batches before this one."""
    before = f"{path}/seen/batch={batch - 1}"
    if batch and path_exists(spark, before):
        return spark.read.schema(SEEN).parquet(before).first().latest
    if batch and path_exists(spark, f"{path}/seen"):
        earlier = spark.read.schema(f"{SEEN}, batch bigint").parquet(f"{path}/seen").filter(F.col("batch") < batch)
        return earlier.agg(F.max("latest")).first()[0]
    return None


def split_late(
    batch: DataFrame, latest: datetime | None, width: str = HOUR, delay: str = WATERMARK_DELAY
) -> DataFrame:
    """Every reading of a batch, with ``window_end`` and ``late``: whether its window ends at or before the watermark."""
    end = wall_clock(F.window(EVENT_TIME, width)["end"])
    # Spark's watermark has milliseconds.
    seen = F.date_trunc("millisecond", F.lit(None if latest is None else str(latest)).cast("timestamp")).cast("timestamp_ntz")
    late = F.coalesce(end <= seen - F.expr(f"interval {delay}"), F.lit(False))
    return batch.withColumn("window_end", end).withColumn("late", late)


def start_late(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    width: str = HOUR,
    delay: str = WATERMARK_DELAY,
    available_now: bool = False,
    every: str = "1 minute",
) -> StreamingQuery:
    """Readings that are late for windows of ``width``, and all others, under ``path``: :func:`read_late` and
    :func:`on_time`."""
    spark = readings.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        if path_exists(spark, f"{path}/seen/batch={number}/_SUCCESS"):
            return
        before = _seen(spark, path, number)
        batch = batch.withColumn(EVENT_TIME, wall_clock(EVENT_TIME))
        marked = split_late(batch, before, width, delay).persist()
        try:
            for side, rows in (("late", marked.filter("late")), ("on_time", marked.filter("not late"))):
                if not path_exists(spark, f"{path}/{side}/batch={number}/_SUCCESS"):
                    rows.drop("late").write.mode("overwrite").parquet(f"{path}/{side}/batch={number}")
            latest = F.greatest(F.max(EVENT_TIME), F.lit(None if before is None else str(before)).cast("timestamp_ntz"))
            sums = marked.agg(latest.alias("latest"), F.count("*").alias("n_rows"), F.count_if("late").alias("n_late"))
            sums.write.mode("overwrite").parquet(f"{path}/seen/batch={number}")
        finally:
            marked.unpersist()

    return start_batches(readings, write, checkpoint, available_now, every)


def _side(schema: T.StructType, *more: T.StructField) -> T.StructType:
    fields = [T.StructField(f.name, T.TimestampNTZType() if f.name == EVENT_TIME else f.dataType) for f in schema]
    return T.StructType([*fields, *more])


def read_late(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Late readings so far: the readings' columns, the end of the window that each missed, and the batch it came in."""
    more = [T.StructField("window_end", T.TimestampNTZType()), T.StructField("batch", T.LongType())]
    return spark.read.schema(_side(schema, *more)).parquet(f"{path}/late")


def on_time(spark: SparkSession, path: str, schema: T.StructType, delay: str = WATERMARK_DELAY, **options: str) -> DataFrame:
    """All other readings as a stream with the same watermark, in the order of the batches they came in."""
    stream = spark.readStream.options(**options).schema(_side(schema)).parquet(f"{path}/on_time/batch=*")
    return watermarked(stream.withColumn(EVENT_TIME, F.col(EVENT_TIME).cast("timestamp")), delay)


def late_counts(spark: SparkSession, path: str) -> DataFrame:
    """``batch, n_rows, n_late``: readings that came, and those of them that were late, one by one."""
    return spark.read.schema(f"{SEEN}, batch bigint").parquet(f"{path}/seen").select("batch", "n_rows", "n_late")
