"""Feature statistics, selection and scaling, all on train rows only."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions import ratios
from pulsegrid.functions.metrics import HOURLY_MARK, named
from pulsegrid.operators.dense import added_up, matrix
from pulsegrid.operators.quantiles import exact_quantiles

# Fixed values of feature selection.
MIN_VARIANCE = 1e-6
MAX_CORRELATION = 0.95
SHIFT_LIMIT = 2.0


def melt(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """(ids..., feature, value), NULL values kept."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), named(c).cast("double").alias("value")) for c in columns])
    return df.select(*ids, F.explode(pairs).alias("_p")).select(*ids, "_p.feature", "_p.value")


def _one_row_to_long(df: DataFrame, columns: Sequence[str], aggs: dict) -> DataFrame:
    """One pass over a wide table, statistics turned into one row per feature."""
    cells = [fn(named(c).cast("double")).alias(f"{i}:{stat}") for i, c in enumerate(columns) for stat, fn in aggs.items()]
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), *[F.col(f"{i}:{stat}").alias(stat) for stat in aggs])
            for i, c in enumerate(columns)
        ]
    )
    return df.agg(*cells).select(F.explode(rows).alias("_r")).select("_r.*")


def variances(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sample variance per feature, NULLs skipped."""
    return _one_row_to_long(df, columns, {"variance": F.var_samp})


def varying(df: DataFrame, columns: Sequence[str], least: float = MIN_VARIANCE) -> DataFrame:
    return variances(df, columns).where(F.col("variance") > least)


def top_by_variance(stats: DataFrame, k: int) -> DataFrame:
    return stats.orderBy(F.desc("variance"), "feature").limit(k)


def scaler_stats(df: DataFrame, columns: Sequence[str], impute: str = "mean") -> DataFrame:
    """Mean, population std and scale (1 where std is zero) per feature.

    With ``impute='zero'`` missing values count as zeros, as they do when the
    matrix is zero-filled before scaling."""
    fill = (lambda c: F.coalesce(c, F.lit(0.0))) if impute == "zero" else (lambda c: c)
    stats = _one_row_to_long(
        df, columns, {"mean": lambda c: F.avg(fill(c)), "std": lambda c: F.stddev_pop(fill(c))}
    )
    return stats.withColumn("scale", F.when(F.col("std") == 0, 1.0).otherwise(F.col("std")))


def scale_columns(df: DataFrame, stats: DataFrame, columns: Sequence[str], impute: str = "mean") -> DataFrame:
    """Imputed, scaled copies of ``columns`` (same names).  The statistics, one
    row per feature, are looked up on the driver and become literals."""
    known = {r["feature"]: r for r in stats.collect()}
    out = {}
    for c in columns:
        mean, scale = F.lit(known[c]["mean"]), F.lit(known[c]["scale"])
        out[c] = (ratios.impute(named(c).cast("double"), mean, impute) - mean) / scale
    return df.withColumns(out)


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(rows where both are present, |Pearson| over these) of every feature pair;
    NaN where it is not defined.

    Each task adds up Gram matrices of the null mask and the null-filled, centred
    values, and only these travel."""
    f = len(columns)
    # centring keeps the sums of squares well conditioned; F numbers
    first = df.agg(*[F.avg(named(c).cast("double")).alias(str(i)) for i, c in enumerate(columns)]).first()
    centre = np.array([v if v is not None else 0.0 for v in first], dtype=float)

    def gram(total: np.ndarray, batch) -> None:
        x = matrix(batch.column(0)) - centre
        m = (~np.isnan(x)).astype(float)
        x = np.nan_to_num(x)
        total += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])

    rows = df.select(F.array(*[named(c).cast("double") for c in columns]).alias("x"))
    n, s, q, p = added_up(rows, gram, (4, f, f))
    with np.errstate(all="ignore"):
        cov, var = p - s * s.T / n, q - s * s / n
        corr = np.where((n > 1) & (var > 0) & (var.T > 0), np.minimum(np.abs(cov / np.sqrt(var * var.T)), 1.0), np.nan)
    return n, corr


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """|Pearson| of every feature pair over the rows where both are present."""
    n, corr = correlation_matrix(df, columns)
    rows = [(columns[i], columns[j], int(round(n[i, j])), None if np.isnan(corr[i, j]) else float(corr[i, j]))
            for i, j in zip(*np.triu_indices(len(columns), 1))]
    return df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, n long, corr double")


def select_features(df: DataFrame, columns: Sequence[str], *, top_k: int | None = None,
                    least_variance: float = MIN_VARIANCE, max_corr: float = MAX_CORRELATION) -> list[str]:
    """Varying features, thinned greedily (an earlier column wins over a later
    one it correlates with), then the ``top_k`` by variance.

    Rows stay in Spark; the driver sees one variance per feature and F x F sums."""
    var = {r["feature"]: r["variance"] for r in varying(df, columns, least_variance).collect()}
    kept = [c for c in columns if c in var]
    if len(kept) > 1:
        close = np.triu(correlation_matrix(df, kept)[1] > max_corr, 1)
        gone = np.zeros(len(kept), bool)
        for i in range(len(kept)):
            if not gone[i]:
                gone |= close[i]
        kept = [c for c, out in zip(kept, gone) if not out]
    if top_k and len(kept) > top_k:
        kept = sorted(kept, key=lambda c: (-var[c], c))[:top_k]
    return kept


def median_shift(df: DataFrame, columns: Sequence[str], is_test, limit: float = SHIFT_LIMIT) -> DataFrame:
    """|median(test) - median(train)| / |median(train)| per feature."""
    side = F.when(is_test, "test").otherwise("train")
    long = melt(df.withColumn("_side", side), columns, ["_side"])
    med = exact_quantiles(long, ["_side", "feature"], "value", [0.5])
    pick = lambda s: F.max(F.when(F.col("_side") == s, F.col("quantile")))
    wide = med.groupBy("feature").agg(pick("train").alias("med_train"), pick("test").alias("med_test"))
    shift = F.abs(F.col("med_test") - F.col("med_train")) / (F.abs(F.col("med_train")) + F.lit(1e-9))
    return wide.withColumn("shift", shift).withColumn("shifted", F.col("shift") > limit)


def feature_set_check(selected: DataFrame, spec: DataFrame, top_k: int, forbidden: Sequence[str]) -> DataFrame:
    """One row per rule on the set of feature names, with the offending count."""
    f = F.col("feature")
    both = selected.select("feature", F.lit(1).alias("s"), F.lit(0).alias("p")).unionByName(
        spec.select("feature", F.lit(0).alias("s"), F.lit(1).alias("p"))
    ).groupBy("feature").agg(F.sum("s").alias("s"), F.sum("p").alias("p"))
    counts = both.agg(
        F.count_if((F.col("s") > 0) & f.isin(*forbidden)).alias("forbidden"),
        F.count_if((F.col("s") > 0) & f.contains(HOURLY_MARK)).alias("hourly"),
        F.count_if((F.col("s") > 0) & (F.col("p") == 0)).alias("not_in_spec"),
        F.count_if((F.col("s") == 0) & (F.col("p") > 0)).alias("missing_from_selection"),
        F.abs(F.sum("s") - F.lit(top_k)).alias("count_off"),
    )
    rules = ("forbidden", "hourly", "not_in_spec", "missing_from_selection", "count_off")
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).cast("long").alias("offending")) for r in rules])
    return counts.select(F.explode(rows).alias("_r")).select("_r.*").withColumn("passed", F.col("offending") == 0)
