"""The feature job: raw samples to the enriched table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions import timeflow as tf
from pulsegrid.functions.metrics import ROLLING_WIDTHS, named
from pulsegrid.operators import asof, intervals, matrix, rolling
from pulsegrid.sources.monitoring import in_range


def feature_matrix(samples: DataFrame, keys: Sequence[str], *, rollups: DataFrame | None = None,
                   width: int = tf.MINUTE, chunk: int = tf.HOUR, rollup_width: int = tf.HOUR,
                   fill_limit: int = 3, share: float = 0.7, **names) -> DataFrame:
    """Pivot, hourly roll-ups, blank hosts out, short gaps filled, sparse rows
    out, chunk tag on.  A row is sparse by the columns that its chunk has values
    for, so several chunks at once give what each gives alone."""
    wide = matrix.named_hosts(matrix.pivot_mean(samples, keys, width=width, **names))
    if rollups is not None:
        wide = matrix.attach_rollups(wide, rollups, width=rollup_width)
    filled = matrix.forward_fill(wide, [c for c in wide.columns if c not in ("host", "bucket")], limit=fill_limit, chunk=chunk)
    return matrix.drop_sparse_by(filled.withColumn("chunk_id", tf.chunk_id(F.col("bucket"), chunk)), "chunk_id", share)


def enriched(wide: DataFrame, metrics: Sequence[str], alarms: DataFrame | None, windows: DataFrame | None, *,
             width: int = tf.MINUTE, widths: Sequence[int] = ROLLING_WIDTHS, label_seconds: int = 600,
             block: int = 1440, alarm_time: str = "alarm_ts") -> DataFrame:
    """Rolling statistics, time since the last alarm, and interval labels.

    ``alarms``: (host, alarm_ts).  ``windows``: (host, start_ts, end_ts).
    Without an alarm source there is no time-since-alarm column and labels come
    from the windows alone."""
    out = rolling.rolling_stats(
        matrix.named_hosts(wide).select("host", "bucket", *[named(m) for m in metrics]), metrics,
        width=width, widths=widths, block=block,
    ).drop(*metrics)
    spans = windows.select("host", "start_ts", "end_ts") if windows is not None else None
    lookups = []
    if alarms is not None:
        lookups.append(asof.Lookup(alarms, alarm_time, alarm_time, "_last_alarm"))
        after = alarms.select(
            "host", F.col(alarm_time).alias("start_ts"), tf.plus_seconds(F.col(alarm_time), label_seconds).alias("end_ts")
        )
        spans = after if spans is None else after.unionByName(spans)
    if spans is None:
        return out.withColumn("is_anomaly", F.lit(0))
    lookups.append(asof.Lookup(spans, "start_ts", "end_ts", "_latest_end"))
    # both questions are answered by one shuffle of the feature rows
    found = asof.running_max_asof(out, lookups, grid=width, block=block * width)
    now = F.col("bucket")
    since = {} if alarms is None else {"time_since_last_alarm": asof.minutes_since(now, F.col("_last_alarm"))}
    return found.withColumns({**since, "is_anomaly": intervals.still_open(now, F.col("_latest_end"))}).drop(
        "_last_alarm", "_latest_end"
    )


def enriched_range(wide: DataFrame, metrics: Sequence[str], alarms, windows, start: Column, end: Column, *,
                   width: int = tf.MINUTE, widths: Sequence[int] = ROLLING_WIDTHS, **kw) -> DataFrame:
    """Only [start, end): reads from ``start`` minus the longest look-back and
    returns the rows of the range, equal to those of a full run."""
    read = in_range(wide, "bucket", tf.plus_seconds(start, -max(widths) * width), end)
    done = enriched(read, metrics, alarms, windows, width=width, widths=widths, **kw)
    return in_range(done, "bucket", start, end)
