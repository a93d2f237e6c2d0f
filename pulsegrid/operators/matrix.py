"""From raw samples to the bucket x host x metric matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions import timeflow as tf
from pulsegrid.functions.metrics import has_host, named, quoted




def join_dimensions(facts: DataFrame, links: Sequence[tuple[DataFrame, Sequence[str] | str]]) -> DataFrame:
    """Inner star join.  Small dimensions are broadcast by Spark's threshold."""
    for dim, key in links:
        facts = facts.join(dim, key)
    return facts


def only_active(facts: DataFrame, active: DataFrame, key: str) -> DataFrame:
    return facts.join(active.select(key), key, "left_semi")


def pivot_mean(
    samples: DataFrame,
    keys: Sequence[str],
    *,
    width: int = tf.MINUTE,
    host: str = "host",
    time: str = "ts",
    key: str = "key_",
    value: str = "value",
) -> DataFrame:
    """(bucket, host) x key mean.

    Means per (host, key, bucket) come first, with partial sums before the
    shuffle: testing every key for every raw sample would cost more than the
    second, far smaller shuffle.
    """
    samples = samples.where(F.col(key).isin(*keys))
    long = long_means(samples, width=width, host=host, time=time, key=key, value=value)
    means = [F.max(F.when(F.col("key_") == k, F.col("value"))).alias(k) for k in keys]
    return long.groupBy("host", "bucket").agg(*means)


def long_means(
    samples: DataFrame, *, width: int = tf.MINUTE, host: str = "host", time: str = "ts",
    key: str = "key_", value: str = "value",
) -> DataFrame:
    """The long table (host, key_, bucket, value)."""
    return samples.groupBy(
        F.col(host).alias("host"), F.col(key).alias("key_"), tf.bucket_start(F.col(time), width).alias("bucket")
    ).agg(F.avg(value).alias("value"))


def pivot_rollups(
    trends: DataFrame,
    keys: Sequence[str],
    *,
    width: int = tf.HOUR,
    host: str = "host",
    time: str = "ts",
    key: str = "key_",
) -> DataFrame:
    """Mean of the stored roll-ups per (period, host, key), all three suffixes
    from one aggregate."""
    columns = {"avg": "value_avg", "min": "value_min", "max": "value_max"}
    trends = trends.where(F.col(key).isin(*keys))
    period = tf.bucket_start(F.col(time), width)
    long = trends.groupBy(F.col(host).alias("host"), F.col(key).alias("key_"), period.alias("period")).agg(
        *[F.avg(c).alias(c) for c in columns.values()]
    )
    stats = [
        F.max(F.when(F.col("key_") == k, F.col(c))).alias(f"{k}_hourly_{suffix}")
        for k in keys for suffix, c in columns.items()
    ]
    return long.groupBy("host", "period").agg(*stats)


def attach_rollups(matrix: DataFrame, rollups: DataFrame, *, width: int = tf.HOUR) -> DataFrame:
    return (
        matrix.withColumn("period", tf.bucket_start(F.col("bucket"), width))
        .join(rollups, ["host", "period"], "left")
        .drop("period")
    )


def keep_last(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key in ``order``.  An aggregate, not a ranked window: the
    winner so far is combined before the shuffle, so repeated keys cost nothing."""
    rest = [c for c in df.columns if c not in key]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*key).agg(last).select(*key, "_row.*")


def forward_fill(
    df: DataFrame, columns: Sequence[str], *, limit: int = 3, chunk: int = tf.HOUR,
    host: str = "host", time: str = "bucket",
) -> DataFrame:
    """Carry the last value over at most ``limit`` following rows of the same
    host and chunk.  A chunk bounds what one task windows."""
    w = (
        Window.partitionBy(host, tf.bucket_index(F.col(time), chunk))
        .orderBy(time)
        .rowsBetween(-limit, Window.currentRow)
    )
    return df.withColumns({c: F.last(named(c), ignorenulls=True).over(w) for c in columns})


def drop_sparse(df: DataFrame, share: float = 0.7) -> DataFrame:
    """Rows that have a value in at least ``int(share * columns)`` columns."""
    return df.dropna(thresh=int(len(df.columns) * share), subset=[quoted(c) for c in df.columns])


def drop_sparse_by(df: DataFrame, chunk: str, share: float = 0.7, ids: Sequence[str] = ("host", "bucket")) -> DataFrame:
    """The same rule where only columns with a value somewhere in the row's chunk
    count: silent columns must not make full rows look sparse."""
    columns = [named(c) for c in df.columns if c != chunk and c not in ids]
    filled = sum((c.isNotNull().cast("int") for c in columns), F.lit(len(ids)))
    there = sum((F.max(c.isNotNull().cast("int")) for c in columns), F.lit(len(ids)))
    present = df.groupBy(chunk).agg(there.alias("_present"))
    return df.join(present, chunk).where(filled >= F.floor(F.col("_present") * F.lit(share))).select(*[named(c) for c in df.columns])


def named_hosts(df: DataFrame, host: str = "host") -> DataFrame:
    return df.where(has_host(F.col(host)))
