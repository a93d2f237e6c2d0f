"""As-of lookups that split every key over time.

A window over ``partitionBy(host)`` puts all history of a host in one task.
Here the time line is cut into blocks: rows are windowed per (host, block), and
one carry row per block brings in the best value of all earlier blocks.  The
right side is first reduced to one row per position, so a host that holds a
third of all alarms costs no more than one row per bucket.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions import timeflow as tf
from pulsegrid.functions.metrics import NO_ALARM_YET


@dataclass(frozen=True)
class Lookup:
    """``out`` = max(``value``) over rows of ``right`` with right time <= left
    time (``<`` when ``strict``) and the same keys; NULL where there is none."""

    right: DataFrame
    time: str
    value: str
    out: str
    strict: bool = False


def running_max_asof(
    left: DataFrame,
    lookups: Sequence[Lookup],
    *,
    on: Sequence[str] = ("host",),
    time: str = "bucket",
    grid: int | None = None,
    block: int | None = None,
) -> DataFrame:
    """Add the column of every lookup to ``left`` in one shuffle of ``left``.

    ``grid``: bucket width in seconds when every left time lies on that grid.
    ``block``: seconds of history that one task windows per key; by default a
    day on a grid, where it holds one row per bucket, and a minute without one.
    Before the main pass the distinct (keys, block) pairs of ``left`` are read,
    so hand over a stored table when ``left`` is costly to compute.
    """
    block = block or (tf.DAY if grid else tf.MINUTE)
    span = max(block // grid, 1) if grid else block * 1_000_000
    in_block = tf.int_div(F.col("_pos"), span)
    best = [f"_best{i}" for i in range(len(lookups))]

    def right_pos(k: Lookup):
        if grid:
            return (tf.bucket_after if k.strict else tf.bucket_ceil)(F.col(k.time), grid)
        return tf.epoch_micros(F.col(k.time)) + F.lit(int(k.strict))

    # one row per key and position; NULL keys or times match nothing
    steps = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [
            k.right.where(" AND ".join(f"`{c}` IS NOT NULL" for c in (*on, k.time)))
            .groupBy(*on, right_pos(k).alias("_pos"))
            .agg(F.max(k.value).alias(b))
            for k, b in zip(lookups, best)
        ],
    ).withColumns({"_block": in_block, "_probe": F.lit(0)})
    left_pos = tf.bucket_index(F.col(time), grid) if grid else tf.epoch_micros(F.col(time))
    probes = left.withColumn("_pos", left_pos).withColumns({"_block": in_block, "_probe": F.lit(1)})

    earlier = Window.partitionBy(*on).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        steps.select(*on, "_block", *best)
        .unionByName(probes.select(*on, "_block"), allowMissingColumns=True)
        .groupBy(*on, "_block")
        .agg(*[F.max(b).alias(b) for b in best])
        .select(
            *on, "_block", (F.col("_block") * F.lit(span)).alias("_pos"), F.lit(0).alias("_probe"),
            *[F.max(b).over(earlier).alias(b) for b in best],
        )
        .where(" OR ".join(f"{b} IS NOT NULL" for b in best))
    )

    upto = (
        Window.partitionBy(*on, "_block").orderBy("_pos", "_probe")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        probes.unionByName(steps, allowMissingColumns=True)
        .unionByName(carry, allowMissingColumns=True)
        .select("*", *[F.max(b).over(upto).alias(k.out) for k, b in zip(lookups, best)])
        .where("_probe = 1")
        .drop("_pos", "_block", "_probe", *best)
    )


def minutes_since(time: Column, alarm: Column) -> Column:
    """Minutes since the alarm; the "no alarm yet" sentinel is applied only
    here, in the last projection."""
    return F.coalesce(tf.seconds_between(time, alarm) / 60.0, F.lit(float(NO_ALARM_YET)))


def time_since_last_alarm(
    rows: DataFrame,
    alarms: DataFrame,
    *,
    host: str = "host",
    time: str = "bucket",
    alarm_time: str = "alarm_ts",
    out: str = "time_since_last_alarm",
    grid: int | None = tf.MINUTE,
    block: int | None = None,
) -> DataFrame:
    """Minutes since the latest alarm at or before each row."""
    found = running_max_asof(
        rows, [Lookup(alarms, alarm_time, alarm_time, "_last_alarm")], on=[host], time=time, grid=grid, block=block
    )
    return found.withColumn(out, minutes_since(F.col(time), F.col("_last_alarm"))).drop("_last_alarm")


def alarm_chain(
    facts: DataFrame,
    links: Sequence[tuple[DataFrame, str, str]],
    how: str = "left",
) -> DataFrame:
    """Facts joined along a chain of dimensions, each link being
    ``(dimension, fact-side key, dimension key)``.

    No broadcast hint: Spark's own size threshold picks a broadcast for small
    dimensions, and a sort-merge join with skew splitting beyond it.
    """
    for dim, left_key, right_key in links:
        facts = facts.join(dim, facts[left_key] == dim[right_key], how)
    return facts


def distinct_alarms(chain: DataFrame, event_id: str, host: str, time: str) -> DataFrame:
    """One row per (event, host), hosts that could not be resolved dropped."""
    return (
        chain.where(F.col(host).isNotNull() & F.col(time).isNotNull())
        .groupBy(event_id, host)
        .agg(F.min(time).alias(time))
    )


def with_fallback(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """``primary``, or ``fallback`` when primary has no row at all.

    The choice is an uncorrelated NOT EXISTS inside the plan, so that no driver
    action decides it."""
    empty = ~primary.select(F.lit(1).alias("x")).limit(1).exists()
    return primary.unionByName(fallback.where(empty), allowMissingColumns=True)
