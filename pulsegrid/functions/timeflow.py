"""Time arithmetic on TIMESTAMP_NTZ that never touches the session time zone.

``date_trunc`` and ``unix_timestamp`` go through the session zone when given an
NTZ value.  Subtracting the NTZ epoch gives an interval instead, and intervals
cast to numbers without any zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTE, HOUR, DAY = 60, 3600, 86400


def epoch_zero() -> Column:
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'")


def ntz(text: str) -> Column:
    return F.expr(f"timestamp_ntz'{text}'")


def int_div(a: Column, b: Column | int) -> Column:
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b).cast("long"))


def epoch_seconds(ts: Column) -> Column:
    return (ts - epoch_zero()).cast("interval second").cast("bigint")


def epoch_micros(ts: Column) -> Column:
    exact = (ts - epoch_zero()).cast("interval second").cast("decimal(20,6)")
    return (exact * F.lit(1_000_000)).cast("bigint")


def seconds_between(later: Column, earlier: Column) -> Column:
    """Exact difference in seconds, as a double."""
    return (later - earlier).cast("interval second").cast("decimal(20,6)").cast("double")


def from_epoch(seconds: Column) -> Column:
    zero = F.lit(0)
    return epoch_zero() + F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))


def as_instant(ts: Column) -> Column:
    """The UTC instant of an NTZ time, for event-time columns of a stream."""
    return F.timestamp_micros(epoch_micros(ts))


def from_instant(ts: Column) -> Column:
    return from_epoch(F.unix_micros(ts).cast("decimal(24,6)") / F.lit(1_000_000))


def plus_seconds(ts: Column, seconds: Column | int) -> Column:
    seconds = seconds if isinstance(seconds, Column) else F.lit(seconds)
    zero = F.lit(0)
    return ts + F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))


def bucket_index(ts: Column, width: int) -> Column:
    return int_div(epoch_seconds(ts), width)


def bucket_ceil(ts: Column, width: int) -> Column:
    """Index of the first bucket that starts at or after ``ts``."""
    step = width * 1_000_000
    return int_div(epoch_micros(ts) + F.lit(step - 1), step)


def bucket_after(ts: Column, width: int) -> Column:
    """Index of the first bucket that starts strictly after ``ts``."""
    return bucket_index(ts, width) + F.lit(1)


def bucket_start(ts: Column, width: int) -> Column:
    return from_epoch(bucket_index(ts, width) * F.lit(width))


def chunk_id(ts: Column, width: int = HOUR) -> Column:
    """``chunk_{start}_{end}`` of the chunk that holds ``ts``."""
    start = bucket_index(ts, width) * F.lit(width)
    return F.concat_ws("_", F.lit("chunk"), start, start + F.lit(width))


def chunk_bounds(chunk: Column) -> tuple[Column, Column]:
    parts = F.split(chunk, "_")
    return parts.getItem(1).cast("long"), parts.getItem(2).cast("long")


def mixed_epoch(text: Column) -> Column:
    """Seconds since the epoch from a string that is a number or a timestamp,
    read as it stands: the session time zone has no influence."""
    stamp = text.try_cast("timestamp_ntz")
    return F.coalesce(F.expr("1D") * text.try_cast("double"), epoch_seconds(stamp).cast("double"))


def calendar(ts: Column) -> dict[str, Column]:
    """hour_of_day, day_of_week (Monday = 0) and is_weekend, as doubles."""
    day = F.weekday(ts)
    return {
        "hour_of_day": F.hour(ts).cast("double"),
        "day_of_week": day.cast("double"),
        "is_weekend": (day >= 5).cast("double"),
    }
