"""The live job: exported lines in, scores and alerts of the active bundle out.

lines -> samples -> once per delivery -> sums per (host, item, bucket), emitted when
the watermark has passed the bucket; then, batch by batch: names valid at the
bucket, bounded history, rolling features, the scores of whichever run is active,
one row per model, and alerts.  Scoring is :func:`pulsegrid.operators.bundle.score`, the same
code as in training and audit.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions import timeflow as tf
from pulsegrid.operators import bundle, evaluate, rolling
from pulsegrid.session import materialize, working_tables
from pulsegrid.streaming import alerts, dimensions, samples
from pulsegrid.streaming.state import History, put_day

CLOSED = "host string, key_ string, bucket timestamp_ntz, value double, n bigint"


@dataclass(frozen=True)
class Live:
    """Where a live job reads and writes.  ``keep``: buckets of history, more than any
    bundle looks back."""

    root: str
    models: str
    items: str
    metrics: Sequence[str]
    width: int = tf.MINUTE
    keep: int = samples.KEEP_MINUTES
    every: int = 8

    @property
    def scores(self) -> str:
        return f"{self.root}/scores"

    @property
    def alerts(self) -> str:
        return f"{self.root}/alerts"


def bucket_sums(lines: DataFrame, *, width: str = "1 minute", delay: str = samples.CLOSE_AFTER, line: str = "line") -> DataFrame:
    """Lines of a stream to (host, itemid, name, bucket, total, n) of closed buckets.
    Names come later, so that a rename between two batches reaches open buckets."""
    typed = samples.live_samples(samples.observed(samples.parse_lines(lines, line)))
    once = samples.once_only(typed, delay=delay)
    return once.groupBy("host", "itemid", "name", F.window("ts", width).alias("_w")).agg(
        F.sum("value").alias("total"), F.count(F.lit(1)).alias("n")
    ).select("host", "itemid", "name", tf.from_instant(F.col("_w.start")).alias("bucket"), "total", "n")


def named_means(sums: DataFrame, known: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Closed means (host, key_, bucket, value, n) under the names valid at the bucket."""
    named = dimensions.keyed(sums, known).where(F.col("key_").isin(*metrics))
    return named.groupBy("host", "key_", "bucket").agg((F.sum("total") / F.sum("n")).alias("value"), F.sum("n").alias("n"))


def feature_rows(long: DataFrame, metrics: Sequence[str], *, width: int, widths: Sequence[int], block: int) -> DataFrame:
    """Rolling and calendar features from closed means."""
    means = [F.max(F.when(F.col("key_") == k, F.col("value"))).alias(k) for k in metrics]
    wide = long.groupBy("host", "bucket").agg(*means)
    rolled = rolling.rolling_stats(wide, metrics, width=width, widths=widths, block=block).drop(*metrics)
    return rolled.withColumns(tf.calendar(F.col("bucket")))


def scorer(at: Live) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function of the live job."""
    loaded: dict[str, bundle.Bundle] = {}

    def models(spark) -> bundle.Bundle | None:
        run_id = bundle.active(spark, at.models)
        if run_id is not None and run_id not in loaded:
            loaded.clear()
            loaded[run_id] = bundle.load(spark, at.models, run_id)
        return loaded.get(run_id)

    def run(sums: DataFrame, batch_id: int) -> None:
        spark = sums.sparkSession
        with working_tables(spark):
            history = History(f"{at.root}/closed", CLOSED, at.keep * at.width, every=at.every)
            history.compact(spark, batch_id)
            mine = history.put(named_means(sums, dimensions.versions(spark, at.items), at.metrics), batch_id)
            first = mine.agg(F.min("bucket").alias("t")).first()["t"]
            now = models(spark)
            if first is None or now is None:
                return
            if bundle.reach(now) >= at.keep:
                raise ValueError(f"run {now.spec['run_id']} looks back {bundle.reach(now)} buckets, {at.keep} are kept")
            start = F.lit(first).cast("timestamp_ntz")
            past = history.before(spark, batch_id).where(F.col("bucket") >= bundle.reach_start(now, start))
            new = mine.select("host", "bucket", F.lit(True).alias("is_new")).distinct()
            rows = feature_rows(past.unionByName(mine), at.metrics, width=at.width, widths=now.spec["widths"], block=now.spec["block"])
            rows = materialize(rows.join(new, ["host", "bucket"], "left").fillna(False, ["is_new"]), "live-rows")
            scores = bundle.score(now, rows, ("host", "bucket", "is_new"), F.col("is_new")).drop("is_new")
            scores = evaluate.apply_thresholds(scores, now.thresholds).withColumn("run_id", F.lit(now.spec["run_id"]))
            scores = materialize(scores, "live-scores")
            put_day(scores, at.scores, batch_id)
            alerts.alert_sink(at.alerts, lambda df: df)(scores, batch_id)

    return run


def votes(scores: DataFrame) -> DataFrame:
    """Any-model vote per host and bucket over stored live scores."""
    return evaluate.vote(scores)
