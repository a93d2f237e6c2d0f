"""Operational figures of streams as a table: rates, lag, backlog, counts on the way.

A query listener turns every progress event into rows and appends them to a table;
reports read the table like any other.
"""

from __future__ import annotations

import datetime as dt
import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from pulsegrid.operators.warehouse import read_or_empty

SCHEMA = (
    "query string, batch_id long, at timestamp, input_rows long, rows_per_minute double, seconds double, "
    "watermark timestamp, lag_minutes double, backlog long, state_rows long, dropped_late long, observed map<string,long>"
)


def backlog(start: str | None, latest: str | None) -> int | None:
    """Bytes or rows that the source has and the batch had not read, where its
    offsets are numbers, or lists that begin with one, per file or partition."""
    try:
        end, newest = json.loads(start or "{}"), json.loads(latest or "null")
    except ValueError:
        return None
    if not isinstance(newest, dict) or not isinstance(end, dict):
        return None
    number = lambda v: v[0] if isinstance(v, list) and v else v
    pairs = [(number(v), number(end.get(k, 0))) for k, v in newest.items()]
    return sum(max(0, a - b) for a, b in pairs) if all(isinstance(x, int) for p in pairs for x in p) else None


def _time(text: str | None) -> dt.datetime | None:
    return dt.datetime.fromisoformat(text.replace("Z", "+00:00")) if text else None


class ProgressLog(StreamingQueryListener):
    """Appends the progress of all queries, or of the query ``name``, to ``path``.

    Rows are written by ``flush``, after every ``every`` events and when a query ends."""

    def __init__(self, spark: SparkSession, path: str, name: str | None = None, every: int = 20) -> None:
        self.spark, self.path, self.name, self.every = spark, path, name, every
        self.rows: list[tuple] = []
        self.lock, self.ended = threading.Lock(), threading.Event()
        self.runs: set[str] = set()

    def onQueryStarted(self, event) -> None:
        if self.name is None or event.name == self.name:
            self.runs.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if self.name is not None and p.name != self.name:
            return
        at, mark = _time(p.timestamp), _time(p.eventTime.get("watermark"))
        seconds = (p.batchDuration or 0) / 1000.0
        counts = {k: int(v) for row in p.observedMetrics.values() for k, v in row.asDict().items() if isinstance(v, int)}
        left = [backlog(s.endOffset, s.latestOffset) for s in p.sources]
        newest = _time(p.eventTime.get("max"))
        self.rows.append((
            p.name or str(p.id), p.batchId, at, p.numInputRows, 60.0 * p.numInputRows / seconds if seconds else None, seconds, mark,
            (at - newest).total_seconds() / 60.0 if newest and p.numInputRows else None,
            sum(x for x in left if x is not None) if any(x is not None for x in left) else None,
            sum(s.numRowsTotal for s in p.stateOperators), sum(s.numRowsDroppedByWatermark for s in p.stateOperators), counts,
        ))
        if len(self.rows) >= self.every:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) in self.runs:
            self.flush()
            self.ended.set()

    def flush(self) -> None:
        with self.lock:
            rows, self.rows = self.rows, []
            if rows:
                self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)


def progress(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, SCHEMA)


def health(log: DataFrame) -> DataFrame:
    """Per query: batches, rows in, bad lines, largest lag and backlog, rate over the busy time."""
    return log.groupBy("query").agg(
        F.count_if(F.col("input_rows") > 0).alias("batches"), F.sum("input_rows").alias("input_rows"),
        F.sum(F.coalesce(F.element_at("observed", "bad_lines"), F.lit(0))).alias("bad_lines"),
        F.sum(F.coalesce(F.element_at("observed", "good_lines"), F.lit(0))).alias("good_lines"),
        F.max("lag_minutes").alias("max_lag_minutes"), F.max("backlog").alias("max_backlog"), F.max("state_rows").alias("max_state_rows"),
        (60.0 * F.sum("input_rows") / F.sum("seconds")).alias("rows_per_minute"),
    )
