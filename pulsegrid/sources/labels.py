"""Labelled anomaly windows, one JSON record per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WINDOW_SCHEMA = (
    "anomaly_id string, type string, host string, label string, start_ts long, end_ts long, "
    "metadata map<string,string>"
)
IDENTITY = ("type", "start_ts", "end_ts")


def read_windows(spark: SparkSession, path: str, default_host: str) -> DataFrame:
    """Blank and malformed lines are skipped, a missing host is the default
    host, and the label falls back to the type."""
    raw = spark.read.schema(WINDOW_SCHEMA + ", _bad string").option("columnNameOfCorruptRecord", "_bad").json(path)
    return raw.where("_bad IS NULL AND start_ts IS NOT NULL AND end_ts IS NOT NULL").drop("_bad").withColumns(
        {
            "host": F.coalesce(F.nullif("host", F.lit("")), F.lit(default_host)),
            "label": F.coalesce("label", "type"),
        }
    )


def list_windows(windows: DataFrame, label: str | None = None, since: int | None = None) -> DataFrame:
    if label:
        windows = windows.where(F.col("label") == label)
    if since:
        windows = windows.where(F.coalesce("start_ts", F.lit(0)) >= since)
    return windows


def new_windows(existing: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates to append: end after start, identity not yet present, and
    once only when the candidates repeat themselves."""
    valid = candidates.where(F.col("end_ts") > F.col("start_ts"))
    rest = [c for c in valid.columns if c not in IDENTITY]
    once = valid.groupBy(*IDENTITY).agg(F.min_by(F.struct(*rest), F.struct("anomaly_id", "host")).alias("_r"))
    fresh = once.select(*IDENTITY, "_r.*").join(existing.select(*IDENTITY), list(IDENTITY), "left_anti")
    return fresh.select(*candidates.columns)


def append_windows(spark: SparkSession, path: str, candidates: DataFrame, default_host: str) -> int:
    """Append and return how many were new."""
    from pulsegrid.operators.warehouse import table_exists
    from pulsegrid.session import materialize

    existing = (
        read_windows(spark, path, default_host) if table_exists(spark, path)
        else spark.createDataFrame([], WINDOW_SCHEMA)
    )
    fresh = materialize(new_windows(existing, candidates), "windows")
    fresh.write.mode("append").json(path)
    return fresh.count()
