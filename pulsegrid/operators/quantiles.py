"""Exact interpolated quantiles without collecting a group.

``percentile`` keeps every distinct value of a group in one task.  Here the
value axis is cut into logarithmic bins, counted with map-side combine.  A bin
that holds a wanted rank and more rows than one task should sort is cut again,
linearly; then only the distinct values of the final bins are ordered.  After
both cuts a bin spans less than 2**-27 of its value, so it holds a bounded
number of distinct doubles whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.session import settle

LOG_BINS = 4096
LINEAR_BINS = 65536


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """(keys..., prob, quantile), linear interpolation between order statistics.

    NULL and NaN values, and rows with a NULL key, are skipped.  ``df`` is read two or three times; pass a stored
    table when it is costly to compute.  The rank targets, at most two rows per
    group and probability, are settled before each join: with few groups
    (models, features) Spark broadcasts them, with many it shuffles.
    """
    x = F.col(value).cast("double")
    log_bin = F.floor(F.signum("x") * F.log1p(F.abs(F.col("x"))) * F.lit(float(LOG_BINS)))
    rows = (
        df.select(*keys, x.alias("x")).where("x IS NOT NULL AND NOT isnan(x)").withColumn("b1", log_bin)
    )
    stats = [F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")]
    upto = Window.unboundedPreceding, Window.currentRow

    def holds_rank(rank: str):
        return (F.col("upto") - F.col("n") <= F.col(rank)) & (F.col(rank) < F.col("upto"))

    # 1. logarithmic histogram, and the ranks wanted from it
    h1 = rows.groupBy(*keys, "b1").agg(*stats)
    whole = Window.partitionBy(*keys)
    h1 = h1.withColumns(
        {
            "upto": F.sum("n").over(whole.orderBy("b1").rowsBetween(*upto)),
            "total": F.sum("n").over(whole),
        }
    )
    place = F.col("prob") * (F.col("total") - 1)
    floor_rank = F.floor(place).cast("long")
    t1 = (
        h1.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        .withColumn("part", place - floor_rank)
        .withColumn("r", F.explode(F.array(floor_rank, F.least(floor_rank + 1, F.col("total") - 1))))
        .withColumn("upper", F.col("r") > floor_rank)
        .where(holds_rank("r"))
        .select(*keys, "prob", "part", "upper", "b1", "lo", "hi", F.col("n").alias("bin_rows"), (F.col("r") - F.col("upto") + F.col("n")).alias("r"))
    )
    t1 = settle(t1, "quantile-bins")

    # 2. linear histogram inside the wanted bins
    bins1 = t1.select(*keys, "b1", "lo", "hi").distinct()
    fine = rows.join(bins1, [*keys, "b1"])
    span = F.col("hi") - F.col("lo")
    linear_bin = F.when(span > 0, F.floor((F.col("x") - F.col("lo")) / span * F.lit(float(LINEAR_BINS)))).otherwise(0)
    fine = fine.withColumn("b2", linear_bin.cast("long")).drop("lo", "hi")
    h2 = fine.groupBy(*keys, "b1", "b2").agg(F.count(F.lit(1)).alias("n"))
    h2 = h2.withColumn("upto", F.sum("n").over(Window.partitionBy(*keys, "b1").orderBy("b2").rowsBetween(*upto)))
    t2 = (
        h2.join(t1.drop("lo", "hi", "bin_rows"), [*keys, "b1"])
        .where(holds_rank("r"))
        .withColumn("r", F.col("r") - F.col("upto") + F.col("n"))
        .drop("n", "upto")
    )
    t2 = settle(t2, "quantile-bins")

    # 3. distinct values of the final bins
    bins2 = t2.select(*keys, "b1", "b2").distinct()
    h3 = fine.join(bins2, [*keys, "b1", "b2"]).groupBy(*keys, "b1", "b2", "x").agg(
        F.count(F.lit(1)).alias("n")
    )
    h3 = h3.withColumn("upto", F.sum("n").over(Window.partitionBy(*keys, "b1", "b2").orderBy("x").rowsBetween(*upto)))
    found = h3.join(t2, [*keys, "b1", "b2"]).where(holds_rank("r"))

    low = F.max(F.when(~F.col("upper"), F.col("x")))
    high = F.coalesce(F.max(F.when(F.col("upper"), F.col("x"))), low)
    done = found.groupBy(*keys, "prob", "part").agg((low + (high - low) * F.col("part")).alias("quantile")).drop("part")
    return settle(done, "quantiles")
