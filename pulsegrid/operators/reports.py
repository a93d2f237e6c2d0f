"""Filtered reads, coverage and report aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions import timeflow as tf
from pulsegrid.functions.metrics import named
from pulsegrid.functions.ratios import ratio

# Page and look-back bounds, report rounding.
FEATURE_PAGE_MAX = 10_000
ALERT_PAGE_MAX = 5_000
LOG_PAGE_MAX = 1_000
HOURS_MAX = 720


def bounded(n: int, low: int, high: int) -> int:
    """``n``, at least ``low``.  More than ``high`` is an error: a report must not
    answer for less than it was asked."""
    if int(n) > high:
        raise ValueError(f"{n} is above the bound of {high}")
    return max(low, int(n))


def _filtered(df: DataFrame, time: str, equal: dict, start, end) -> DataFrame:
    for column, wanted in equal.items():
        if wanted is not None:
            df = df.where(F.col(column) == wanted)
    if start is not None:
        df = df.where(F.col(time) >= start)
    if end is not None:
        df = df.where(F.col(time) <= end)
    return df


def feature_page(df: DataFrame, *, host: str | None = None, start: Column | None = None,
                 end: Column | None = None, columns: Sequence[str] | None = None, limit: int = 500,
                 offset: int = 0, time: str = "bucket") -> tuple[DataFrame, DataFrame]:
    """(page, total).  ``end`` is inclusive, key columns always come along, and
    an unknown column is an error."""
    keys = [time, "host"]
    if columns is not None:
        unknown = [c for c in columns if c not in df.columns]
        if unknown:
            raise ValueError(f"unknown column(s): {unknown}")
        df = df.select(*keys, *[named(c) for c in columns if c not in keys])
    hit = _filtered(df, time, {"host": host}, start, end)
    page = hit.orderBy(time, "host").offset(max(0, int(offset))).limit(bounded(limit, 1, FEATURE_PAGE_MAX))
    return page, hit.agg(F.count(F.lit(1)).alias("total"))


def alert_page(alerts: DataFrame, *, model: str | None = None, host: str | None = None,
               start: Column | None = None, end: Column | None = None, limit: int = 200,
               offset: int = 0, time: str = "bucket") -> tuple[DataFrame, DataFrame]:
    """Newest first, ties broken by host and model."""
    hit = _filtered(alerts, time, {"model": model, "host": host}, start, end)
    page = hit.orderBy(F.desc(time), "host", "model").offset(max(0, int(offset))).limit(bounded(limit, 1, ALERT_PAGE_MAX))
    return page, hit.agg(F.count(F.lit(1)).alias("total"))


def newest(df: DataFrame, order: Sequence[Column], limit: int = 100) -> DataFrame:
    return df.orderBy(*order).limit(bounded(limit, 1, LOG_PAGE_MAX))


def last_hours(df: DataFrame, hours: int, as_of: Column, time: str = "bucket") -> DataFrame:
    """Rows of the last ``hours`` before ``as_of`` (a literal or a scalar subquery)."""
    return df.where(F.col(time) >= tf.plus_seconds(as_of, -bounded(hours, 1, HOURS_MAX) * tf.HOUR))


def score_series(alerts: DataFrame, model: str, hours: int, as_of: Column, time: str = "bucket") -> DataFrame:
    """Score and threshold of one model, in time order."""
    hit = last_hours(alerts.where(F.col("model") == model), hours, as_of, time)
    return hit.orderBy(time, "host").select(time, "host", "score", "threshold")


def alert_summary(alerts: DataFrame, hours: int, as_of: Column, time: str = "bucket") -> DataFrame:
    r4 = lambda c: F.round(c, 4)
    return last_hours(alerts, hours, as_of, time).groupBy("model").agg(
        F.count(F.lit(1)).alias("n_alerts"),
        r4(F.avg("score")).alias("avg_score"),
        r4(F.min("score")).alias("min_score"),
        r4(F.max("score")).alias("max_score"),
        r4(F.avg("threshold")).alias("threshold"),
        F.min(time).alias("first_alert"),
        F.max(time).alias("last_alert"),
    )


def coverage(tables: dict[str, DataFrame], time: str = "bucket") -> DataFrame:
    """Row count and time range of each table, one row per table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows"), F.min(time).alias("min_time"), F.max(time).alias("max_time"))
        .select(F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def freshness(features: DataFrame, alerts: DataFrame, time: str = "bucket") -> DataFrame:
    part = lambda df, name: df.agg(F.count(F.lit(1)).alias("n_rows"), F.max(time).alias("latest")).select(
        F.lit(name).alias("part"), "n_rows", "latest"
    )
    return part(features, "features").unionByName(part(alerts, "alerts"))


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def count_by_label(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(F.coalesce(F.col(label), F.lit("?")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def comparison_summary(comparison: DataFrame) -> DataFrame:
    caught = F.col("caught")
    return comparison.groupBy("model").agg(
        F.count(F.lit(1)).alias("windows"),
        F.count_if(caught).alias("caught_windows"),
        F.round(F.avg(F.when(caught, F.col("latency_min"))), 2).alias("avg_latency_min"),
        F.round(ratio(F.count_if(caught), F.count(F.lit(1))), 3).alias("catch_rate"),
    )


def best_model(metrics: DataFrame) -> DataFrame:
    """Highest F1; equal F1 goes to the first name."""
    return metrics.orderBy(F.desc(F.coalesce("f1", F.lit(0.0))), "model").limit(1).select("model", "f1")


def alerts_per_hour(alerts: DataFrame, time: str = "bucket") -> DataFrame:
    return alerts.groupBy("model", tf.bucket_start(F.col(time), tf.HOUR).alias("hour")).agg(
        F.count(F.lit(1)).alias("n_alerts")
    )


def sliding_rate(events: DataFrame, time: str, *, width: int = 300, step: int = 60, by: Sequence[str] = ()) -> DataFrame:
    """Events per second over sliding windows.  Counts per step come first, so
    the overlap multiplies step counts and not raw events."""
    steps = events.groupBy(*by, tf.bucket_index(F.col(time), step).alias("_s")).agg(F.count(F.lit(1)).alias("_n"))
    reach = F.sequence(F.col("_s"), F.col("_s") + F.lit(width // step - 1))
    return (
        steps.withColumn("_s", F.explode(reach))
        .groupBy(*by, tf.from_epoch((F.col("_s") + F.lit(1)) * F.lit(step)).alias("window_end"))
        .agg(F.sum("_n").alias("n"))
        .withColumn("per_second", F.col("n") / F.lit(float(width)))
    )
