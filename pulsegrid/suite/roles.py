"""How the given tables play the roles of monitoring tables.

samples   events: host = h<user_id % 5>, metric key = event_type
bucket    one hour (30 days of events leave single minutes almost empty)
alarms    error events above 100
windows   purchase events above 250, ten hours long, in event_id order
second    orders: host = nation of the customer, key = priority, bucket = day
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions import timeflow as tf
from pulsegrid.operators import evaluate, intervals, matrix, rolling
from pulsegrid.session import materialize

KEYS = ["click", "error", "purchase", "signup", "view"]
WIDTHS = (5, 30, 60)
WIDTH = tf.HOUR
BLOCK = 240  # buckets of one host that one task windows
SPLIT = "2024-01-20 00:00:00"
ROLL = dict(width=WIDTH, widths=WIDTHS, block=BLOCK)
GRID = dict(grid=WIDTH, block=BLOCK * WIDTH)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def split():
    return tf.ntz(SPLIT)


def rnd(x, digits: int = 6):
    """Rounds a computed double for comparison.  An exact decimal tie would be
    settled by the order of summation, which neither engine fixes; a shift far
    below the last digit, the same in the SQL, settles it one way."""
    return F.round(x + F.lit(3 * 10.0 ** -(digits + 2)), digits)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: rnd(F.col(c), digits) for c in columns})


def host_of_user():
    return F.concat(F.lit("h"), (F.col("user_id") % 5).cast("string"))


def samples(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", host_of_user().alias("host"), F.col("event_type").alias("key_"), "ts", "value"
    )


def wide(spark, sf) -> DataFrame:
    return matrix.pivot_mean(samples(spark, sf), KEYS, width=WIDTH)


def alarms(spark, sf) -> DataFrame:
    return samples(spark, sf).where("key_ = 'error' AND value > 100").select("host", F.col("ts").alias("alarm_ts"))


def windows(spark, sf) -> DataFrame:
    return samples(spark, sf).where("key_ = 'purchase' AND value > 250").select(
        F.col("event_id").alias("seq_no"), "host", F.col("ts").alias("start_ts"),
        tf.plus_seconds(F.col("ts"), 10 * tf.HOUR).alias("end_ts"),
        F.concat(F.lit("win_"), (F.col("event_id") % 7).cast("string")).alias("label"),
    )


def trends(spark, sf) -> DataFrame:
    """Hourly roll-ups of the samples, per item = (host, key)."""
    return samples(spark, sf).groupBy("host", "key_", tf.bucket_start(F.col("ts"), tf.HOUR).alias("ts")).agg(
        F.count(F.lit(1)).alias("num"), F.min("value").alias("value_min"),
        F.avg("value").alias("value_avg"), F.max("value").alias("value_max"),
    )


def rolled_all(spark, sf) -> DataFrame:
    return rolling.rolling_stats(wide(spark, sf), KEYS, **ROLL)


def zscores(rolled: DataFrame, ids=("host", "bucket")) -> DataFrame:
    """Scores of every metric; click gives the models z<w>, key k gives k_z<w>."""
    parts = [evaluate.rolling_zscore(rolled, k, WIDTHS, ids=ids).withColumn(
        "model", F.col("model") if k == KEYS[0] else F.concat(F.lit(f"{k}_"), F.col("model"))) for k in KEYS]
    return reduce(DataFrame.unionByName, parts)


def scores(spark, sf) -> DataFrame:
    return zscores(rolled_all(spark, sf))


def labelled_scores(spark, sf) -> DataFrame:
    """All scores with their truth, stored: thresholds read them three times."""
    rows = intervals.in_any_window(rolled_all(spark, sf), windows(spark, sf), out="y_true", **GRID)
    return materialize(zscores(rows, ids=("host", "bucket", "y_true")), "scores")


def predictions(spark, sf, prob: float = 0.99) -> DataFrame:
    """Test-side predictions of all models, with truth from the windows.
    A scan of the stored scores joined with three thresholds: cheap to read again."""
    train, test = evaluate.time_split(labelled_scores(spark, sf), split())
    return evaluate.apply_thresholds(test, evaluate.thresholds(train, [prob]))


def alerts(spark, sf) -> DataFrame:
    return predictions(spark, sf).where("y_pred = 1").select("model", "host", "bucket", "score", "threshold")


def metrics(spark, sf, prob: float = 0.99) -> DataFrame:
    return evaluate.prf(predictions(spark, sf, prob))


def test_windows(spark, sf) -> DataFrame:
    return windows(spark, sf).where(F.col("start_ts") >= split())


def comparison(spark, sf) -> DataFrame:
    compared = intervals.compare_windows(
        predictions(spark, sf), test_windows(spark, sf),
        window_key=["seq_no", "host", "start_ts", "end_ts", "label"], grid=WIDTH,
    )
    return intervals.detection_latency(compared)


def newest(df: DataFrame, time: str = "bucket"):
    """The newest time of a table, standing in for "now"."""
    return df.agg(F.max(time).alias("t")).scalar()


# ---- the same roles in SQL -------------------------------------------------

S = """s AS (SELECT event_id, 'h' || (user_id % 5)::VARCHAR AS host, event_type AS key_, ts,
     date_trunc('hour', ts) AS bucket, value FROM events)"""
M = "m AS (SELECT host, bucket, " + ", ".join(
    f"avg(value) FILTER (key_ = '{k}') AS {k}" for k in KEYS) + " FROM s GROUP BY host, bucket)"
A = "a AS (SELECT DISTINCT host, ts AS alarm_ts FROM s WHERE key_ = 'error' AND value > 100)"
W = """w AS (SELECT event_id AS seq_no, host, ts AS start_ts, ts + INTERVAL 10 HOUR AS end_ts,
     'win_' || (event_id % 7)::VARCHAR AS label FROM s WHERE key_ = 'purchase' AND value > 250)"""
TR = """tr AS (SELECT host, key_, bucket AS ts, count(*) AS num, min(value) AS value_min,
     avg(value) AS value_avg, max(value) AS value_max FROM s GROUP BY host, key_, bucket)"""


def sql_over(w: int) -> str:
    return f"(PARTITION BY host ORDER BY epoch(bucket)::BIGINT // 3600 RANGE BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"


def sql_stat(c: str, stat: str, w: int) -> str:
    o = sql_over(w)
    if stat == "avg":
        return f"avg({c}) OVER {o}"
    if stat == "std":
        return f"coalesce(stddev_pop({c}) OVER {o}, 0)"
    return (f"CASE WHEN count({c}) OVER {o} >= 2 THEN (last_value({c} IGNORE NULLS) OVER {o} - "
            f"first_value({c} IGNORE NULLS) OVER {o}) / count({c}) OVER {o} ELSE 0 END")


R = f"r AS (SELECT host, bucket, {', '.join(KEYS)}, " + ", ".join(
    f"{sql_stat(k, st, w)} AS {k}_{st}_{w}m" for k in KEYS for w in WIDTHS for st in ("avg", "std", "trend")) + " FROM m)"
SC = "sc AS (" + " UNION ALL ".join(
    f"SELECT host, bucket, '{'' if k == KEYS[0] else k + '_'}z{w}' AS model, CASE WHEN {k}_std_{w}m > 0 THEN abs({k} - {k}_avg_{w}m) "
    f"/ {k}_std_{w}m END AS score FROM r" for k in KEYS for w in WIDTHS) + ")"


def sql_predictions(prob: float = 0.99, tag: str = "", before: str = SPLIT, rows: str = f"sc.bucket >= TIMESTAMP '{SPLIT}'") -> str:
    return f"""th{tag} AS (SELECT model, quantile_cont(score, {prob}) AS threshold FROM sc
      WHERE bucket < TIMESTAMP '{before}' GROUP BY model),
    p{tag} AS (SELECT sc.model, sc.host, sc.bucket, sc.score, th{tag}.threshold,
      coalesce((sc.score > th{tag}.threshold)::INT, 0) AS y_pred,
      (EXISTS (SELECT 1 FROM w WHERE w.host = sc.host AND sc.bucket >= w.start_ts AND sc.bucket < w.end_ts))::INT AS y_true
      FROM sc JOIN th{tag} ON sc.model = th{tag}.model WHERE {rows})"""


def sql_metrics(p: str = "p") -> str:
    return f"""(SELECT model, round(pr, 4) AS precision, round(re, 4) AS recall,
      round(CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END, 4) AS f1, n_pred_pos, n_test_rows
     FROM (SELECT model, CASE WHEN np > 0 THEN tp / np ELSE 0 END AS pr, CASE WHEN nt > 0 THEN tp / nt ELSE 0 END AS re,
       np AS n_pred_pos, n AS n_test_rows
      FROM (SELECT model, count(*) FILTER (y_pred = 1 AND y_true = 1) AS tp, count(*) FILTER (y_pred = 1) AS np,
        count(*) FILTER (y_true = 1) AS nt, count(*) AS n FROM {p} WHERE score IS NOT NULL GROUP BY model)))"""


SAMPLES = f"WITH {S}"
WIDE = f"WITH {S}, {M}"
ROLLED = f"{WIDE}, {R}"
PRED = f"{ROLLED}, {SC}, {W}, {sql_predictions()}"
COMP = f"""{PRED}, wt AS (SELECT * FROM w WHERE start_ts >= TIMESTAMP '{SPLIT}'),
  c AS (SELECT *, floor(epoch(first_detected - start_ts) / 60)::BIGINT AS latency_min, detected_minutes > 0 AS caught
   FROM (SELECT p.model, wt.seq_no, wt.host, wt.start_ts, wt.end_ts, wt.label, count(*) AS rows_inside,
    count(*) FILTER (y_pred = 1) AS detected_minutes, min(p.bucket) FILTER (y_pred = 1) AS first_detected
    FROM wt JOIN p ON p.host = wt.host AND p.bucket >= wt.start_ts AND p.bucket < wt.end_ts GROUP BY ALL))"""
