"""Counts of each micro-batch, stored: a listener writes what Spark reports and what jobs ``observe`` into a table.

One file per query and micro-batch, ``<path>/<query>-<batch>.json``, written again when a batch is replayed. Listeners run
on the driver beside the queries and only write these few lines; no rows of the stream pass through them.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from martpulse.sources.paths import matching, write_text

SCHEMA = "query string, batch_id long, at string, name string, value double"


def lines_of(query: str, progress) -> list[dict]:
    """One record per number of a progress report: rows read, rows dropped as late, and every observed value."""
    late = sum(s.numRowsDroppedByWatermark or 0 for s in progress.stateOperators or [])
    numbers = {"input_rows": progress.numInputRows, "late_rows_dropped": late}
    for metric, row in (progress.observedMetrics or {}).items():
        numbers.update({f"{metric}.{k}": v for k, v in row.asDict().items()})
    return [{"query": query, "batch_id": progress.batchId, "at": progress.timestamp, "name": k, "value": float(v)}
            for k, v in numbers.items() if isinstance(v, (int, float))]


class BatchCounts(StreamingQueryListener):
    """Register with ``spark.streams.addListener``; queries without a name are left out."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name:
            text = "\n".join(map(json.dumps, lines_of(p.name, p))) + "\n"
            write_text(self.spark, f"{self.path}/{p.name}-{p.batchId:09d}.json", text)

    def onQueryTerminated(self, event) -> None:
        pass


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """``(query, batch_id, at, name, value)`` of all stored micro-batches."""
    return spark.read.schema(SCHEMA).json(path)


def wait_for(spark: SparkSession, path: str, query, seconds: float = 60) -> None:
    """Until the last report of a finished, named query is stored (listeners run behind)."""
    last, end = query.lastProgress, time.time() + seconds
    while last and not matching(spark, f"{path.rstrip('/')}/{query.name}-{last.batchId:09d}.json"):
        if time.time() > end:
            raise TimeoutError(f"no counts of {query.name}, batch {last.batchId}")
        time.sleep(0.1)
