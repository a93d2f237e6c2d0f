"""Splits, thresholds, predictions and their scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions import timeflow as tf
from pulsegrid.functions.ratios import f1_score, ratio0
from pulsegrid.operators.quantiles import exact_quantiles

# Least test rows, random-baseline repeats, tolerances.
MIN_TEST_ROWS = 1440
BASELINE_REPEATS = 50
METRIC_TOLERANCE = 0.05


def split_point(newest: Column, days: int = 14) -> Column:
    """A moving split: ``days`` before the newest time, floored to the hour."""
    return tf.bucket_start(tf.plus_seconds(newest, -days * tf.DAY), tf.HOUR)


def time_split(df: DataFrame, split: Column, time: str = "bucket") -> tuple[DataFrame, DataFrame]:
    """(train, test): train lies strictly before the split."""
    return df.where(F.col(time) < split), df.where(F.col(time) >= split)


def side_of(split: Column, time: str = "bucket") -> Column:
    return F.when(F.col(time) < split, "train").otherwise("test")


def split_stats(df: DataFrame, split: Column, time: str = "bucket") -> DataFrame:
    return df.groupBy(side_of(split, time).alias("side")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        tf.epoch_seconds(F.min(time)).alias("min_ts"),
        tf.epoch_seconds(F.max(time)).alias("max_ts"),
    )


def sufficiency(df: DataFrame, split: Column, least: int = MIN_TEST_ROWS, time: str = "bucket") -> DataFrame:
    n = F.count_if(F.col(time) >= split)
    return df.agg(n.alias("test_rows")).withColumn("enough", F.col("test_rows") >= least)


def shared_times(train: DataFrame, test: DataFrame, time: str = "bucket") -> DataFrame:
    """Number of train rows whose time also occurs in test."""
    return train.join(test.select(time), time, "left_semi").agg(F.count(F.lit(1)).alias("shared"))


def audit_split(train: DataFrame, test: DataFrame, split: Column, time: str = "bucket") -> DataFrame:
    """Ordering rules of a train and a test table: one row per rule with the
    number of rows that break it."""
    def count(df: DataFrame, condition: Column) -> Column:
        return df.agg(F.count_if(condition).alias("n")).scalar()

    both = train.join(test.select(time).distinct(), time, "left_semi").agg(F.count(F.lit(1)).alias("n")).scalar()
    broken = {"test_before_split": count(test, F.col(time) < split), "train_after_split": count(train, F.col(time) >= split),
              "shared_times": both}
    one = train.sparkSession.range(1)
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), n.alias("offending")) for r, n in broken.items()])
    return one.select(F.explode(rows).alias("_r")).select("_r.*").withColumn("passed", F.col("offending") == 0)


def rolling_zscore(df: DataFrame, metric: str, widths: Sequence[int], ids: Sequence[str] = ("host", "bucket")) -> DataFrame:
    """Scores |x - avg_w| / std_w of a table that carries the rolling columns;
    one "model" z<w> per width; NULL where std is 0 or the metric is missing."""
    def row(w: int) -> Column:
        std = F.col(f"{metric}_std_{w}m")
        score = F.when(std > 0, F.abs(F.col(metric) - F.col(f"{metric}_avg_{w}m")) / std)
        return F.struct(F.lit(f"z{w}").alias("model"), score.alias("score"))

    return df.select(*ids, F.explode(F.array(*[row(w) for w in widths])).alias("_s")).select(*ids, "_s.*")


def thresholds(scores: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(model, prob, threshold): exact quantile of the train scores per model."""
    return exact_quantiles(scores, ["model"], "score", probs).withColumnRenamed("quantile", "threshold")


def apply_thresholds(scores: DataFrame, limits: DataFrame) -> DataFrame:
    """y_pred = 1 when the score is strictly above the model's threshold; an
    unscorable row is 0.  ``limits`` has one row per model and comes settled,
    so that scores are not shuffled by their few models."""
    flag = F.coalesce((F.col("score") > F.col("threshold")).cast("int"), F.lit(0))
    return scores.join(limits.select("model", "threshold"), "model").withColumn("y_pred", flag)


def prf(predictions: DataFrame, by: Sequence[str] = ("model",), digits: int | None = 4) -> DataFrame:
    """Precision, recall and F1 over scored rows; a zero denominator gives 0."""
    pred, true = F.col("y_pred") == 1, F.col("y_true") == 1
    p, r = ratio0(F.col("tp"), F.col("n_pred_pos")), ratio0(F.col("tp"), F.col("n_true"))
    rnd = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    return (
        predictions.where("score IS NOT NULL AND NOT isnan(score)")
        .groupBy(*by)
        .agg(
            F.count_if(pred & true).alias("tp"), F.count_if(pred).alias("n_pred_pos"),
            F.count_if(true).alias("n_true"), F.count(F.lit(1)).alias("n_test_rows"),
        )
        .select(*by, rnd(p).alias("precision"), rnd(r).alias("recall"), rnd(f1_score(p, r)).alias("f1"),
                "n_pred_pos", "n_test_rows")
    )


def reconcile(ours: DataFrame, stored: DataFrame, tolerance: float = METRIC_TOLERANCE) -> DataFrame:
    """Re-scored precision and recall against the stored ones."""
    o, s = ours.alias("o"), stored.alias("s")
    close = lambda c: F.abs(F.col(f"o.{c}") - F.col(f"s.{c}")) < tolerance
    return o.join(s, "model").select(
        "model",
        F.col("o.precision").alias("precision"), F.col("s.precision").alias("stored_precision"),
        F.col("o.recall").alias("recall"), F.col("s.recall").alias("stored_recall"),
        (close("precision") & close("recall")).alias("consistent"),
    )


def degradation(new: DataFrame, active: DataFrame, tolerance: float = METRIC_TOLERANCE) -> DataFrame:
    """A model degraded when its F1 fell by more than the tolerance."""
    n, a = new.alias("n"), active.alias("a")
    return n.join(a, "model").select(
        "model", F.col("n.f1").alias("new_f1"), F.col("a.f1").alias("active_f1"),
        (F.col("n.f1") < F.col("a.f1") - tolerance).alias("degraded"),
    )


def random_baseline(rows: DataFrame, *, truth: str = "y_true", row_key: Sequence[str] = ("host", "bucket"),
                    repeats: int = BASELINE_REPEATS, seed: int = 0) -> DataFrame:
    """Best F1 of random labelings at the true positive rate.

    All repeats are counted side by side in one aggregate.  The draws are
    32-bit pieces of a digest of the row key, so a retried task draws the same
    and any engine can repeat them."""
    rate = rows.agg(F.avg(F.col(truth).cast("double")).alias("r")).scalar()
    true = F.col(truth) == 1
    digest = lambda i: F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(str(i)), *[F.col(k).cast("string") for k in row_key]))
    draw = lambda i: F.conv(F.substring(F.col(f"_d{i // 4}"), 1 + 8 * (i % 4), 8), 16, 10).cast("bigint") < F.col("_limit")
    drawn = rows.withColumns(
        {"_limit": rate * F.lit(float(1 << 32)), **{f"_d{i}": digest(i) for i in range(-(-repeats // 4))}}
    )
    counted = drawn.agg(
        F.count_if(true).alias("pos"),
        *[F.count_if(draw(i)).alias(f"p{i}") for i in range(repeats)],
        *[F.count_if(draw(i) & true).alias(f"t{i}") for i in range(repeats)],
    )
    f1 = lambda i: ratio0(2 * F.col(f"t{i}"), F.col(f"p{i}") + F.col("pos"))
    return counted.select(F.lit(repeats).alias("repeats"), F.array_max(F.array(*[f1(i) for i in range(repeats)])).alias("best_f1"))


def vote(scored: DataFrame, by: Sequence[str] = ("host", "bucket")) -> DataFrame:
    """Any-model vote per host and time."""
    over = F.col("score") > F.col("threshold")
    return scored.where("score IS NOT NULL AND NOT isnan(score)").groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_models"), F.count_if(over).alias("n_anomaly_models"),
        F.bool_or(over).alias("alert"), F.max("score").alias("max_score"),
    )


def threshold_margin(scored: DataFrame, limits: DataFrame, time: str = "bucket") -> DataFrame:
    """Latest score per model against its threshold."""
    latest = scored.where("score IS NOT NULL").groupBy("model").agg(
        F.max_by("score", F.struct(time, "host")).alias("score"), F.max(time).alias("latest")
    )
    gap = F.col("score") - F.col("threshold")
    return latest.join(limits.select("model", "threshold"), "model").withColumns(
        {"margin": gap, "active": (gap > 0).cast("int")}
    )
