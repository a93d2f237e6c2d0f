"""The feature path over a fleet that grows with the data: minute buckets, a host
per user, and one host that holds a third of all samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsegrid.functions import timeflow as tf
from pulsegrid.operators import asof, evaluate, intervals, matrix, rolling
from pulsegrid.operators.quantiles import exact_quantiles
from pulsegrid.session import materialize
from pulsegrid.suite.registry import query
from pulsegrid.suite.roles import KEYS, SPLIT, rounded, split, table

WIDTHS = (5, 30, 60)
GRID = dict(grid=tf.MINUTE, block=tf.DAY)

S = """s AS (SELECT CASE WHEN user_id % 3 = 0 THEN 'hot' ELSE 'u' || user_id::VARCHAR END AS host, event_type AS key_, ts,
     date_trunc('minute', ts) AS bucket, value, event_id FROM events)"""
M = "m AS (SELECT host, bucket, " + ", ".join(f"avg(value) FILTER (key_ = '{k}') AS {k}" for k in KEYS) + " FROM s GROUP BY 1, 2)"
A = "a AS (SELECT DISTINCT host, ts AS alarm_ts FROM s WHERE key_ = 'error' AND value > 100)"
W = "w AS (SELECT event_id AS seq_no, host, ts AS start_ts, ts + INTERVAL 90 MINUTE AS end_ts FROM s WHERE key_ = 'purchase' AND value > 100)"


def _over(w: int, keys: str = "host") -> str:
    return f"(PARTITION BY {keys} ORDER BY epoch(bucket)::BIGINT // 60 RANGE BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"


def _stat(c: str, stat: str, w: int, keys: str = "host") -> str:
    o = _over(w, keys)
    if stat == "avg":
        return f"avg({c}) OVER {o}"
    if stat == "std":
        return f"coalesce(stddev_pop({c}) OVER {o}, 0)"
    return (f"CASE WHEN count({c}) OVER {o} >= 2 THEN (last_value({c} IGNORE NULLS) OVER {o} - "
            f"first_value({c} IGNORE NULLS) OVER {o}) / count({c}) OVER {o} ELSE 0 END")


def samples(spark, sf):
    host = F.when(F.col("user_id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("user_id").cast("string")))
    return table(spark, sf, "events").select(host.alias("host"), F.col("event_type").alias("key_"), "ts", "value", "event_id")


def wide(spark, sf):
    return matrix.pivot_mean(samples(spark, sf), KEYS)


def windows(spark, sf):
    return samples(spark, sf).where("key_ = 'purchase' AND value > 100").select(
        F.col("event_id").alias("seq_no"), "host", F.col("ts").alias("start_ts"), tf.plus_seconds(F.col("ts"), 90 * tf.MINUTE).alias("end_ts"))


@query("fleet_pivot", f"WITH {S}, {M} SELECT host, bucket, " + ", ".join(f"round({k} + 3e-8, 6) AS {k}" for k in KEYS) + " FROM m")
def fleet_pivot(spark, sf):
    return rounded(wide(spark, sf), *KEYS)


ROLLED = [f"{k}_{s}_{w}m" for k in KEYS for w in WIDTHS for s in ("avg", "std", "trend")]


@query("fleet_rolling", f"WITH {S}, {M} SELECT host, bucket, " + ", ".join(
    f"round({_stat(k, s, w)} + 3e-8, 6) AS {k}_{s}_{w}m" for k in KEYS for w in WIDTHS for s in ("avg", "std", "trend")) + " FROM m")
def fleet_rolling(spark, sf):
    return rounded(rolling.rolling_stats(wide(spark, sf), KEYS, widths=WIDTHS).drop(*KEYS), *ROLLED)


@query("fleet_asof", f"""WITH {S}, {M}, {A} SELECT m.host, m.bucket,
 round(coalesce((epoch_us(m.bucket) - epoch_us(a.alarm_ts)) / 60000000.0, 999999) + 3e-8, 6) AS time_since_last_alarm
FROM m ASOF LEFT JOIN a ON m.host = a.host AND m.bucket >= a.alarm_ts""")
def fleet_asof(spark, sf):
    alarms = samples(spark, sf).where("key_ = 'error' AND value > 100").select("host", F.col("ts").alias("alarm_ts"))
    rows = materialize(wide(spark, sf).select("host", "bucket"), "rows")
    return rounded(asof.time_since_last_alarm(rows, alarms, **GRID), "time_since_last_alarm")


@query("fleet_labels", f"""WITH {S}, {M}, {W}, iv AS (SELECT m.host, m.bucket, max(w.end_ts) AS last_end FROM m JOIN w ON w.host = m.host AND w.start_ts <= m.bucket
 AND w.start_ts > m.bucket - INTERVAL 90 MINUTE GROUP BY 1, 2)
SELECT m.host, m.bucket, coalesce(iv.last_end > m.bucket, false)::INT AS is_anomaly FROM m LEFT JOIN iv ON m.host = iv.host AND m.bucket = iv.bucket""")
def fleet_labels(spark, sf):
    rows = materialize(wide(spark, sf).select("host", "bucket"), "rows")
    return intervals.in_any_window(rows, windows(spark, sf), **GRID)


@query("fleet_quantiles", f"""WITH {S} SELECT host, prob, round(q + 3e-8, 6) AS quantile FROM (
 SELECT host, unnest([0.5, 0.99]::DOUBLE[]) AS prob, unnest(quantile_cont(value, [0.5, 0.99])) AS q FROM s GROUP BY host)""")
def fleet_quantiles(spark, sf):
    return rounded(exact_quantiles(samples(spark, sf), ["host"], "value", [0.5, 0.99]), "quantile")


@query("fleet_detector", f"""WITH {S}, ml AS (SELECT host, key_, bucket, avg(value) AS value FROM s GROUP BY 1, 2, 3),
 r AS (SELECT host, key_, bucket, value, {_stat('value', 'avg', 60, 'host, key_')} AS a, {_stat('value', 'std', 60, 'host, key_')} AS d FROM ml),
 sc AS (SELECT host, key_ AS model, bucket, CASE WHEN d > 0 THEN abs(value - a) / d END AS score FROM r),
 th AS (SELECT model, quantile_cont(score, 0.99) AS threshold FROM sc WHERE bucket < TIMESTAMP '{SPLIT}' GROUP BY model HAVING count(score) > 0)
SELECT sc.model, host, bucket, round(score + 3e-8, 6) AS score, coalesce((score > threshold)::INT, 0) AS y_pred FROM sc JOIN th ON sc.model = th.model
WHERE bucket >= TIMESTAMP '{SPLIT}'""")
def fleet_detector(spark, sf):
    """Rolling z-scores per host and metric on the minute grid, with train thresholds."""
    rolled = rolling.rolling_stats(matrix.long_means(samples(spark, sf)), ["value"], keys=("host", "key_"), widths=(60,), stats=("avg", "std"))
    scored = evaluate.rolling_zscore(rolled, "value", (60,), ids=("host", "key_", "bucket")).drop("model").withColumnRenamed("key_", "model")
    train, test = evaluate.time_split(materialize(scored, "scores"), split())
    flags = evaluate.apply_thresholds(test, evaluate.thresholds(train, [0.99]))
    return rounded(flags.select("model", "host", "bucket", "score", "y_pred"), "score")
