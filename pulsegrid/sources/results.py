"""Result tables of training runs and the notification log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVAL_SCHEMA = (
    "model string, thr_quantile double, threshold double, precision double, recall double, f1 double, "
    "n_pred_pos int, n_test_rows int, test_min_ts bigint, test_max_ts bigint, n_train_rows int, "
    "train_min_ts bigint, train_max_ts bigint"
)
COMPARISON_SCHEMA = (
    "model string, window_start bigint, window_end bigint, label string, latency_min double, caught boolean, "
    "detected_minutes int, own_alarm_overlap boolean"
)
PREDICTION_SCHEMA = (
    "datetime_minute timestamp_ntz, host string, model string, score double, y_pred int, y_true int, anomaly string"
)


def write_result(df: DataFrame, root: str, run_id: str, name: str, fmt: str = "csv") -> str:
    """A result table of one run below ``root/run_id=.../name``."""
    path = f"{root}/run_id={run_id}/{name}"
    writer = df.write.mode("overwrite")
    (writer.option("header", True).csv(path) if fmt == "csv" else writer.parquet(path))
    return path


def read_result(spark: SparkSession, root: str, name: str, schema: str, run_id: str = "*") -> DataFrame:
    """The table of one run, or of all runs with their ``run_id``."""
    df = spark.read.schema(schema).option("header", True).csv(f"{root}/run_id={run_id}/{name}")
    found = F.regexp_extract(F.col("_metadata.file_path"), r"run_id=([^/]+)/", 1)
    return df.select("*", found.alias("run_id"))


def read_predictions(predictions: DataFrame, model: str | None = None, limit: int | None = None,
                     order: tuple[str, ...] = ()) -> DataFrame:
    if model is not None:
        predictions = predictions.where(F.col("model") == model)
    if order:
        predictions = predictions.orderBy(*order)
    return predictions if limit is None else predictions.limit(limit)


def notifications(alerts: DataFrame, received_at: Column, extra: Column | None = None, time: str = "datetime_minute") -> DataFrame:
    """Log rows with the whole notification as a JSON payload; keys of the
    ``extra`` map are merged over the fixed ones."""
    keys = ("host", time, "model", "score", "threshold")
    fixed = F.create_map(*[x for k in keys for x in (F.lit(k), F.col(k).cast("string"))])
    body = fixed if extra is None else F.map_concat(F.map_filter(fixed, lambda k, _: ~F.map_contains_key(extra, k)), extra)
    return alerts.select(*keys, F.to_json(body).alias("payload"), received_at.alias("received_at"))
