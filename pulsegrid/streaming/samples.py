"""Live samples: parse, clean, de-duplicate, and close minutes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions import timeflow as tf

# Closing delay of a minute and length of the kept series.
CLOSE_AFTER = "1 minute"
KEEP_MINUTES = 180
#: Our own: how far a clock may be ahead of the time its sample arrives.
AHEAD_SECONDS = 3600

LINE_SCHEMA = (
    "host struct<host:string>, itemid bigint, name string, clock bigint, ns int, value string, type int, _bad string"
)


def parse_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """(parsed fields or NULLs, is_bad).  A malformed line never fails a batch."""
    doc = F.from_json(F.col(line), LINE_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return lines.withColumn("_doc", doc).withColumn("is_bad", F.col("_doc").isNull() | F.col("_doc._bad").isNotNull())


def observed(parsed: DataFrame, name: str = "lines") -> DataFrame:
    """Counts good and bad lines on the way; read them from the query progress."""
    counts = [F.count_if("is_bad").alias("bad_lines"), F.count_if(~F.col("is_bad")).alias("good_lines")]
    if "_doc" in parsed.columns:
        counts.append(F.count_if(~F.col("is_bad") & ahead_of_arrival(F.col("_doc.clock"))).alias("ahead_lines"))
    return parsed.observe(name, *counts)


def ahead_of_arrival(clock: Column, arrival: Column | None = None) -> Column:
    """Is a clock further ahead of its arrival than clocks drift?  One such sample
    would move the watermark past all real data."""
    now = F.current_timestamp() if arrival is None else arrival
    return F.coalesce(clock > F.unix_timestamp(now) + F.lit(AHEAD_SECONDS), F.lit(False))


def live_samples(parsed: DataFrame, arrival: Column | None = None) -> DataFrame:
    """Typed samples with the defaults of the live path: missing host and name
    are empty, a value that is no finite number is 0.  Samples whose clock is
    ahead of ``arrival``, by default now, are left out; ``observed`` counts them."""
    d = lambda f: F.col(f"_doc.{f}")
    clock = F.coalesce(d("clock"), F.lit(0).cast("bigint"))
    number = d("value").try_cast("double")
    value = F.when(number.isNull() | F.isnan(number) | (F.abs(number) == float("inf")), F.lit(0.0)).otherwise(number)
    return parsed.where(~F.col("is_bad") & ~ahead_of_arrival(d("clock"), arrival)).select(
        F.coalesce(d("host.host"), F.lit("")).alias("host"),
        F.coalesce(d("itemid"), F.lit(0).cast("bigint")).alias("itemid"),
        F.coalesce(d("name"), F.lit("")).alias("name"),
        clock.alias("clock"),
        F.coalesce(d("ns"), F.lit(0)).alias("ns"),
        value.alias("value"),
        F.timestamp_seconds(clock).alias("ts"),
    )


def once_only(samples: DataFrame, keys=("itemid", "clock", "ns"), time: str = "ts", delay: str = CLOSE_AFTER) -> DataFrame:
    """Drop repeated deliveries; state older than the watermark is forgotten."""
    return samples.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def with_metric_key(samples: DataFrame, items: DataFrame) -> DataFrame:
    """Item id to metric key; an unknown item keeps its display name."""
    return samples.join(items.select("itemid", "key_"), "itemid", "left").withColumn(
        "key_", F.coalesce("key_", "name")
    )


def closed_means(samples: DataFrame, *, time: str = "ts", width: str = "1 minute", keys=("host", "key_")) -> DataFrame:
    """Mean per bucket, emitted once the watermark has passed the bucket."""
    return (
        samples.groupBy(*keys, F.window(time, width).alias("_w"))
        .agg(F.avg("value").alias("value"), F.count(F.lit(1)).alias("n"))
        .select(*keys, tf.from_instant(F.col("_w.start")).alias("bucket"), "value", "n")
    )


def sliding_means(samples: DataFrame, *, time: str = "ts", width: str = "5 minutes", step: str = "1 minute", keys=("host", "key_")) -> DataFrame:
    return (
        samples.groupBy(*keys, F.window(time, width, step).alias("_w"))
        .agg(F.avg("value").alias("value"), F.count(F.lit(1)).alias("n"))
        .select(*keys, tf.from_instant(F.col("_w.end")).alias("window_end"), "value", "n")
    )
