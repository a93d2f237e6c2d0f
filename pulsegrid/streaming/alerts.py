"""Scoring of closed buckets and the idempotent alert sink."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.streaming.state import days_of, put_day

ALERT_KEY = ("host", "bucket", "model")


def exceeding(scored: DataFrame, source: str = "realtime") -> DataFrame:
    """One alert per model whose score is above its threshold."""
    return scored.where(F.col("score") > F.col("threshold")).select(
        *ALERT_KEY, "score", "threshold", F.lit(source).alias("source")
    )


def alert_sink(root: str, score: Callable[[DataFrame], DataFrame], key: Sequence[str] = ALERT_KEY) -> Callable[[DataFrame, int], None]:
    """``foreachBatch``-style function: score features, append new alerts by day.

    ``features`` is a stored table.  A key already alerted by an earlier batch is not
    written again, a replayed batch replaces only what it has written, and only
    the days of the batch are looked up."""
    def run(features: DataFrame, batch_id: int) -> None:
        found = exceeding(score(features))
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields)
        earlier = days_of(features.sparkSession, root, features, schema).where(F.col("batch_id") < batch_id)
        fresh = found.dropDuplicates(list(key)).join(earlier.select(*key), list(key), "left_anti")
        put_day(fresh, root, batch_id)

    return run
