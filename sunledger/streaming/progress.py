"""What a running query says about itself."""

from __future__ import annotations

import json
import time
from collections import defaultdict

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

WAIT_SECONDS = 10


class Totals(StreamingQueryListener):
    """Adds up every progress event of every query of a session. Spark itself holds the last hundred only."""

    def __init__(self) -> None:
        self.batches: dict[str, set[int]] = defaultdict(set)
        self.input_rows: dict[str, int] = defaultdict(int)
        self.late_rows: dict[str, int] = defaultdict(int)
        self.open_rows: dict[str, int] = defaultdict(int)
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        report = json.loads(event.progress.json)
        run, states = report["runId"], report["stateOperators"]
        self.batches[run].add(report["batchId"])
        self.input_rows[run] += report["numInputRows"]
        self.late_rows[run] += sum(state["numRowsDroppedByWatermark"] for state in states)
        self.open_rows[run] = sum(state["numRowsTotal"] for state in states)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))


_totals: dict[str, Totals] = {}


def watch(spark: SparkSession) -> Totals:
    """The session's totals; they count from the first call on, so jobs call this before they start a query."""
    app = spark.sparkContext.applicationId
    if app not in _totals:
        _totals[app] = Totals()
        spark.streams.addListener(_totals[app])
    return _totals[app]


def progress_report(query: StreamingQuery, spark: SparkSession | None = None) -> dict[str, int]:
    """Sums over all progress of a run started by this package's jobs; of an ended one, once its last event is in.

    ``late_rows`` counts rows that came after their window had closed. Spark counts them after the map-side
    sum, so several late readings of one window and source may count as one; :mod:`sunledger.streaming.late` keeps
    and counts each.
    """
    totals, run = watch(spark or SparkSession.active()), str(query.runId)
    waited = time.monotonic() + WAIT_SECONDS
    while not query.isActive and run not in totals.ended and time.monotonic() < waited:
        time.sleep(0.05)
    return {
        "batches": len(totals.batches[run]),
        "input_rows": totals.input_rows[run],
        "late_rows": totals.late_rows[run],
        "open_rows": totals.open_rows[run],
    }
