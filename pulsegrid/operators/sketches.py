"""Quantiles of any range of days from one sketch per day.

A threshold over weeks of scores need not read the scores again: each (model, day) is
summed up in a KLL sketch (Karnin, Lang, Liberty 2016), a few kilobytes whatever the
number of rows, and the sketches of a range are merged.  The exact form stays
:func:`pulsegrid.operators.quantiles.exact_quantiles`; this one is for ranges too
large to read, and says how far its ranks can be off.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size parameter of the sketches; the rank error falls about with its inverse.
SIZE = 4000
#: Confidence of the error bound that the method's authors publish.
CONFIDENCE = 0.99


def rank_error(size: int = SIZE) -> float:
    """Largest difference between a value's rank and the wanted one, as a share of
    all rows, with the confidence above; the published fit for merged sketches."""
    # Fixed values of that fit.
    return 2.296 / size ** 0.9723


def daily(df: DataFrame, keys: Sequence[str], value: str, time: str = "bucket", size: int = SIZE) -> DataFrame:
    """(keys..., day, sketch, n); NULL and NaN values and rows with a NULL key are
    left out.  Partial sketches are merged map-side, so a hot key costs no more."""
    x = F.col(value).cast("double")
    clean = df.where(x.isNotNull() & ~F.isnan(x)).where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys) or "true")
    return clean.groupBy(*keys, F.date_format(time, "yyyy-MM-dd").alias("day")).agg(
        F.kll_sketch_agg_double(x, F.lit(size)).alias("sketch"), F.count(F.lit(1)).alias("n"))


def quantiles(sketches: DataFrame, keys: Sequence[str], probs: Sequence[float], size: int = SIZE) -> DataFrame:
    """(keys..., prob, quantile, n, rank_error) of all days in ``sketches``: filter
    them by day first."""
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"), F.sum("n").alias("n"))
    found = [F.struct(F.lit(float(p)).alias("prob"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("quantile")) for p in probs]
    return merged.select(*keys, "n", F.explode(F.array(*found)).alias("_q")).select(
        *keys, "_q.prob", "_q.quantile", "n", F.lit(rank_error(size)).alias("rank_error"))
