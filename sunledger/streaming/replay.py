"""Replay of stored readings as message files, by event-time slot, or to a stream in bounded runs of slots."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sunledger.operators.project import messages
from sunledger.schemas import EVENT_TIME, SLOT
from sunledger.session import path_exists
from sunledger.sinks.topics import publish_files, stage_slices, staged_names

FOLDER = "%Y%m%dT%H%M%S"


def write_slots(readings: DataFrame, path: str, step: str = SLOT) -> None:
    """All readings as message files, one folder per slot, in one distributed write: a source that must be parsed to know
    its times, as CSV, is scanned once whatever the number of slots. A slot with very many readings is split over files.

    A finished write is left as it is, so an interrupted replay goes on; an unfinished one is written anew.
    """
    if path_exists(readings.sparkSession, f"{path}/_SUCCESS"):
        return
    slot = F.date_format(F.window(EVENT_TIME, step)["start"], "yyyyMMdd'T'HHmmss").alias("slot")
    rows = messages(readings, slot).select("value", "slot").hint("rebalance", F.col("slot"))
    rows.write.mode("overwrite").partitionBy("slot").text(path)


def replay(readings: DataFrame, path: str, step: str = SLOT) -> Iterator[tuple[datetime, str]]:
    """``(slot, folder)`` of every slot with readings, in event-time order, each folder complete. A stream over
    ``path/*`` that takes all of them in at once counts every reading; one that takes them in by and by must get them in
    order, as :func:`replay_in_order` hands them over."""
    write_slots(readings, path, step)
    spark = readings.sparkSession
    # One value per slot comes back: they grow with the time range, not with the rows.
    found = spark.read.schema("value string, slot string").text(path).select("slot").distinct().collect()
    for slot in sorted(row.slot for row in found):
        yield datetime.strptime(slot, FOLDER), f"{path}/slot={slot}"


def replay_in_order(
    readings: DataFrame, staging: str, path: str, start: Callable[[str], StreamingQuery], run: str = "1 day"
) -> Iterator[str]:
    """History into a stream in event-time order: one run of slots after the other becomes visible under ``path``, and
    ``start(path)`` takes it in, as one bounded trigger on the checkpoint that all runs share. Each run that is done is
    yielded, by its first slot.

    The watermark moves between micro-batches, and a run is one of them: nothing comes late, however the tasks that
    wrote it went. A replay that was stopped goes on with the first run that was not published; the stream's checkpoint
    knows whether the one before was taken in whole.
    """
    stage_slices(readings, staging, run)
    spark = readings.sparkSession
    if path_exists(spark, f"{path}/*"):
        start(path).awaitTermination()
    for name in staged_names(spark, staging):
        publish_files(spark, staging, path, [name])
        start(path).awaitTermination()
        yield name
