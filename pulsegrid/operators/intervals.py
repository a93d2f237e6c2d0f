"""Interval joins whose cost is linear in rows plus windows.

Existence needs no pairs at all: a row is inside some window [s, e) exactly
when the largest end among windows that started at or before it is still ahead.

For "which window" and "what happened in each window" the bucket axis is
halved repeatedly.  A window splits into at most two aligned blocks per level,
and a row lies in one block per level, so both sides meet by equality on
(host, level, block) and can be aggregated before they meet.  However many
windows overlap one bucket, no pair list is ever built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions import timeflow as tf
from pulsegrid.operators.asof import Lookup, running_max_asof

# 2**40 buckets is far beyond any time axis; it only bounds the level list
MAX_LEVEL = 40


def in_any_window(
    rows: DataFrame,
    windows: DataFrame,
    *,
    on: Sequence[str] = ("host",),
    time: str = "bucket",
    start: str = "start_ts",
    end: str = "end_ts",
    out: str = "is_anomaly",
    grid: int | None = tf.MINUTE,
    block: int | None = None,
) -> DataFrame:
    """1 where the row lies in a half-open window of the same keys, else 0."""
    look = Lookup(windows, start, end, "_latest_end")
    latest = running_max_asof(rows, [look], on=on, time=time, grid=grid, block=block)
    return latest.withColumn(out, still_open(F.col(time), F.col("_latest_end"))).drop("_latest_end")


def still_open(time: Column, latest_end: Column) -> Column:
    return F.coalesce(latest_end > time, F.lit(False)).cast("int")


def _window_blocks(lo: Column, hi: Column) -> Column:
    """Aligned blocks that tile the bucket range [lo, hi)."""
    levels = F.sequence(F.lit(0), F.lit(MAX_LEVEL))

    def pieces(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("long"), level)
        first = tf.int_div(lo + size - F.lit(1), size)
        stop = tf.int_div(hi, size)
        make = lambda node, keep: F.when(
            keep & (first < stop), F.struct(level.alias("level"), node.alias("node"))
        )
        return F.array(
            make(first, first % 2 == 1),
            make(stop - F.lit(1), stop % 2 == 1),
        )

    return F.array_compact(F.flatten(F.transform(levels, pieces)))


def _tiles(windows: DataFrame, start: str, end: str, grid: int) -> DataFrame:
    lo = tf.bucket_ceil(F.col(start), grid)
    hi = tf.bucket_ceil(F.col(end), grid)
    return (
        windows.withColumns({"_lo": lo, "_hi": hi})
        .where("_lo < _hi")
        .withColumn("_tile", F.explode(_window_blocks(F.col("_lo"), F.col("_hi"))))
        .withColumns({"_level": F.col("_tile.level"), "_node": F.col("_tile.node")})
        .drop("_lo", "_hi", "_tile")
    )


def _at_levels(rows: DataFrame, tiles: DataFrame, time: str, grid: int) -> DataFrame:
    """Each row once per level that occurs among the tiles (at most a few)."""
    top = tiles.agg(F.max("_level")).scalar()
    levels = F.sequence(F.lit(0), top)
    pos = tf.bucket_index(F.col(time), grid)
    size = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_level"))
    return rows.withColumn("_level", F.explode(levels)).withColumn("_node", tf.int_div(pos, size))


def first_window_label(
    rows: DataFrame,
    windows: DataFrame,
    *,
    row_key: Sequence[str],
    on: Sequence[str] = ("host",),
    time: str = "bucket",
    start: str = "start_ts",
    end: str = "end_ts",
    order: str = "seq_no",
    label: str = "label",
    grid: int = tf.MINUTE,
) -> DataFrame:
    """Per row: y_true, and the label of the first window in file order that
    contains it.  ``row_key`` identifies a row and is what is returned."""
    tiles = _tiles(windows, start, end, grid)
    best = tiles.groupBy(*on, "_level", "_node").agg(
        F.min(F.struct(F.col(order).alias("o"), F.col(label).alias("l"))).alias("_first")
    )
    keys = rows.select(*row_key)
    # most rows lie in no window and drop out here, before the second shuffle
    found = (
        _at_levels(keys, tiles, time, grid)
        .join(best, [*on, "_level", "_node"])
        .groupBy(*row_key)
        .agg(F.min("_first").alias("_first"))
    )
    return keys.join(found, list(row_key), "left").select(
        *row_key,
        F.col("_first").isNotNull().cast("int").alias("y_true"),
        F.coalesce(F.col("_first.l"), F.lit("")).alias("anomaly"),
    )


def compare_windows(
    predictions: DataFrame,
    windows: DataFrame,
    *,
    window_key: Sequence[str],
    on: Sequence[str] = ("host",),
    model: str = "model",
    time: str = "bucket",
    predicted: str = "y_pred",
    start: str = "start_ts",
    end: str = "end_ts",
    grid: int = tf.MINUTE,
) -> DataFrame:
    """Per (model, window): rows inside, detected rows, first detection.

    Windows with no prediction row are absent.  ``window_key`` identifies a
    window and must include ``on``, start and end."""
    tiles = _tiles(windows.select(*window_key), start, end, grid)
    hit = F.col(predicted) == 1
    summed = (
        _at_levels(predictions.select(model, *on, time, predicted), tiles, time, grid)
        .groupBy(model, *on, "_level", "_node")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(hit).alias("d"),
            F.min(F.when(hit, F.col(time))).alias("f"),
        )
    )
    return (
        tiles.join(summed, [*on, "_level", "_node"])
        .groupBy(model, *window_key)
        .agg(
            F.sum("n").alias("rows_inside"),
            F.sum("d").alias("detected_minutes"),
            F.min("f").alias("first_detected"),
        )
    )


def detection_latency(compared: DataFrame, start: str = "start_ts") -> DataFrame:
    """Whole minutes from window start to first detection, and ``caught``."""
    minutes = F.floor(tf.seconds_between(F.col("first_detected"), F.col(start)) / 60.0)
    return compared.withColumns(
        {"latency_min": minutes.cast("long"), "caught": F.col("detected_minutes") > 0}
    )


def alarm_overlap(
    windows: DataFrame,
    alarms: DataFrame,
    *,
    on: Sequence[str] = ("host",),
    start: str = "start_ts",
    end: str = "end_ts",
    alarm_time: str = "alarm_ts",
    alarm_len: int = 600,
    mode: str = "overlap",
    out: str = "own_alarm_overlap",
    block: int | None = None,
) -> DataFrame:
    """Does an alarm window [a, a + alarm_len] touch the anomaly window?

    ``overlap``: the two half-open windows intersect.
    ``compat``: the anomaly's start lies in [a, a+len) or its end in [a, a+len];
    alarms strictly inside the anomaly window do not count.
    All tests ask only for the latest alarm before a point in time.
    """
    look = lambda df, t, out_col, strict: running_max_asof(
        df, [Lookup(alarms, alarm_time, alarm_time, out_col, strict)], on=on, time=t, block=block
    )
    ends = lambda c: tf.plus_seconds(F.col(c), alarm_len)
    if mode == "overlap":
        found = look(windows, end, "_a", True)
        test = ends("_a") > F.col(start)
    elif mode == "compat":
        found = look(look(windows, start, "_a", False), end, "_b", False)
        test = F.coalesce(ends("_a") > F.col(start), F.lit(False)) | (ends("_b") >= F.col(end))
    else:
        raise ValueError(f"unknown overlap mode: {mode}")
    return found.withColumn(out, F.coalesce(test, F.lit(False))).drop("_a", "_b")
