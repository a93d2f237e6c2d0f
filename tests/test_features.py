"""Hand-computed cases and brute force on random data."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulsegrid.functions import metrics as mx
from pulsegrid.functions import timeflow as tf
from pulsegrid.operators import asof, features, intervals, matrix, rolling
from pulsegrid.operators.quantiles import exact_quantiles
from pulsegrid.plans import enrich

T0 = dt.datetime(2026, 7, 23, 11, 55)


def minute(n):
    return T0 + dt.timedelta(minutes=n)


@pytest.fixture(scope="module")
def constant(spark):
    rows = [(minute(i), "h1", 1.0) for i in range(20)]
    return spark.createDataFrame(rows, "bucket timestamp_ntz, host string, `system.cpu.util` double")


def test_alarm_minutes_and_labels(spark, constant):
    alarms = spark.createDataFrame([("h1", minute(5))], "host string, alarm_ts timestamp_ntz")
    out = enrich.enriched(constant, ["system.cpu.util"], alarms, None, block=7)
    got = {r["bucket"]: r for r in out.collect()}
    assert got[minute(0)]["time_since_last_alarm"] == 999999
    assert got[minute(5)]["time_since_last_alarm"] == 0.0
    assert got[minute(10)]["time_since_last_alarm"] == 5.0
    assert [got[minute(i)]["is_anomaly"] for i in range(20)] == [0] * 5 + [1] * 10 + [0] * 5
    assert got[minute(9)]["system.cpu.util_avg_5m"] == 1.0
    assert got[minute(9)]["system.cpu.util_std_5m"] == 0.0
    assert got[minute(9)]["system.cpu.util_trend_5m"] == 0.0


def test_no_alarm_source(spark, constant):
    out = enrich.enriched(constant, ["system.cpu.util"], None, None)
    assert "time_since_last_alarm" not in out.columns
    assert out.agg(F.sum("is_anomaly")).first()[0] == 0


def test_metric_predicate(spark):
    cases = {"system.cpu.util": True, "vm.memory.size[available]": True, "system.cpu.util_hourly_avg": False,
             "datetime_minute": False, "host": False}
    df = spark.createDataFrame([(k,) for k in cases], "k string").select("k", mx.metric_key(F.col("k")).alias("m"))
    assert {r["k"]: r["m"] for r in df.collect()} == cases
    assert mx.metric_columns(cases) == [k for k, v in cases.items() if v]


def test_session_zone_does_not_matter(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # inside the hour that does not exist on the local clock
        t = dt.datetime(2024, 3, 10, 2, 30, 15)
        df = spark.createDataFrame([(t,)], "ts timestamp_ntz").select(
            tf.epoch_seconds(F.col("ts")).alias("e"), tf.bucket_start(F.col("ts"), 60).alias("m"),
            tf.from_instant(tf.as_instant(F.col("ts"))).alias("back"), tf.mixed_epoch(F.lit("2024-03-10 05:00:00")).alias("x"),
        )
        r = df.first()
        assert r["e"] == int(t.replace(tzinfo=dt.timezone.utc).timestamp())
        assert r["m"] == t.replace(second=0) and r["back"] == t
        assert r["x"] == dt.datetime(2024, 3, 10, 5, tzinfo=dt.timezone.utc).timestamp()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.fixture(scope="module")
def random_matrix():
    """Three hosts, gaps, an all-null stretch; host a holds most rows."""
    rng = np.random.default_rng(7)
    parts = []
    for host, n in (("a", 400), ("b", 60), ("c", 3)):
        at = np.sort(rng.choice(np.arange(700), n, replace=False))
        x = np.where(rng.random(n) < 0.4, np.nan, rng.normal(10, 5, n).round(3))
        if host == "a":
            x[100:190] = np.nan
        parts.append(pd.DataFrame({"host": host, "m": at, "x": x}))
    return pd.concat(parts, ignore_index=True)


def to_spark(spark, pdf):
    rows = [(h, minute(int(m)), None if np.isnan(x) else float(x)) for h, m, x in pdf[["host", "m", "x"]].itertuples(index=False)]
    return spark.createDataFrame(rows, "host string, bucket timestamp_ntz, x double")


def test_rolling_against_brute_force(spark, random_matrix):
    widths = (5, 30, 60)
    got = rolling.rolling_stats(to_spark(spark, random_matrix), ["x"], widths=widths, block=50).toPandas()
    got = got.set_index(["host", "bucket"])
    assert len(got) == len(random_matrix)
    for host, group in random_matrix.groupby("host"):
        m, x = group["m"].to_numpy(), group["x"].to_numpy()
        for i in range(len(m)):
            row = got.loc[(host, minute(int(m[i])))]
            for w in widths:
                v = x[(m > m[i] - w) & (m <= m[i])]
                v = v[~np.isnan(v)]
                avg = v.mean() if len(v) else np.nan
                trend = (v[-1] - v[0]) / len(v) if len(v) > 1 else 0.0
                np.testing.assert_allclose(row[f"x_avg_{w}m"], avg, rtol=1e-9)
                np.testing.assert_allclose(row[f"x_std_{w}m"], v.std() if len(v) else 0.0, atol=1e-9)
                np.testing.assert_allclose(row[f"x_trend_{w}m"], trend, atol=1e-9)


def test_long_and_wide_rolling_agree(spark, random_matrix):
    wide = to_spark(spark, random_matrix)
    a = rolling.rolling_stats(wide, ["x"], block=50).drop("x")
    b = rolling.rolling_stats(wide.withColumnRenamed("x", "value").withColumn("key_", F.lit("x")), ["value"], keys=("host", "key_"), block=91)
    b = b.drop("key_", "value").toDF(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_many_metrics(spark):
    keys = [f"k{i}" for i in range(20)]
    samples = spark.range(4000).select(
        F.concat(F.lit("h"), F.col("id") % 3).alias("host"), F.concat(F.lit("k"), F.col("id") % 20).alias("key_"),
        tf.from_epoch(F.col("id") * 7).alias("ts"), (F.col("id") % 13).cast("double").alias("value"),
    )
    one_step = matrix.pivot_mean(samples, keys)
    rolls = samples.selectExpr("host", "key_", "ts", "value AS value_avg", "value - 1 AS value_min", "value + 1 AS value_max")
    by_hand = samples.groupBy("host", tf.bucket_start(F.col("ts"), 60).alias("bucket")).pivot("key_", keys).agg(F.avg("value"))
    assert one_step.exceptAll(by_hand).count() == 0 and one_step.count() == by_hand.count()
    one_roll = matrix.pivot_rollups(rolls, keys, width=60)
    assert one_roll.count() == one_step.count() and len(one_roll.columns) == 2 + 3 * len(keys)
    wide = rolling.rolling_stats(one_step, keys, widths=(5,), block=64)
    long = rolling.rolling_long(one_step, keys, widths=(5,), block=64).where("key_ = 'k7'")
    a = wide.select("host", "bucket", "k7_avg_5m", "k7_std_5m", "k7_trend_5m")
    b = long.select("host", "bucket", "value_avg_5m", "value_std_5m", "value_trend_5m")
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()


def test_train_features_do_not_see_test_rows(spark, random_matrix):
    wide = to_spark(spark, random_matrix)
    cut = F.lit(minute(300)).cast("timestamp_ntz")
    changed = wide.withColumn("x", F.when(F.col("bucket") >= cut, F.lit(1e6)).otherwise(F.col("x")))
    before, after = (rolling.rolling_stats(d, ["x"], block=64).where(F.col("bucket") < cut) for d in (wide, changed))
    assert before.exceptAll(after).count() == 0


def test_chunked_features_equal_full_run(spark, random_matrix):
    wide = to_spark(spark, random_matrix)
    alarms = spark.createDataFrame([("a", minute(40)), ("a", minute(333)), ("b", minute(50))], "host string, alarm_ts timestamp_ntz")
    full = enrich.enriched(wide, ["x"], alarms, None, block=60)
    at = lambda n: F.lit(minute(n)).cast("timestamp_ntz")
    parts = [enrich.enriched_range(wide, ["x"], alarms, None, at(a), at(a + 175), block=60) for a in range(0, 700, 175)]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    cols = [c for c in full.columns if c not in ("host", "bucket")]
    join = full.alias("f").join(union.alias("u"), ["host", "bucket"])
    assert union.count() == full.count() == join.count()
    far = [(F.abs(F.col(f"f.`{c}`") - F.col(f"u.`{c}`")) > 1e-9) | (F.col(f"f.`{c}`").isNull() != F.col(f"u.`{c}`").isNull()) for c in cols]
    bad = far[0]
    for f in far[1:]:
        bad = bad | f
    assert join.where(bad).count() == 0


def test_asof_and_labels_against_brute_force(spark, random_matrix):
    rng = np.random.default_rng(3)
    secs = rng.integers(0, 700 * 60, 60)
    hosts = rng.choice(["a", "b", "d"], 60)
    lens = rng.integers(1, 4000, 60)
    at = lambda s: T0 + dt.timedelta(seconds=int(s))
    wins = spark.createDataFrame(
        [(i, h, at(s), at(s + n), f"l{i % 5}") for i, (h, s, n) in enumerate(zip(hosts, secs, lens))],
        "seq_no int, host string, start_ts timestamp_ntz, end_ts timestamp_ntz, label string",
    )
    rows = to_spark(spark, random_matrix).select("host", "bucket")
    alarms = wins.select("host", F.col("start_ts").alias("alarm_ts"))
    since = asof.time_since_last_alarm(rows, alarms, block=3600).toPandas().set_index(["host", "bucket"])
    free = asof.time_since_last_alarm(rows, alarms, grid=None, block=7200).toPandas().set_index(["host", "bucket"])
    flag = intervals.in_any_window(rows, wins, block=3600).toPandas().set_index(["host", "bucket"])
    first = intervals.first_window_label(rows, wins, row_key=["host", "bucket"]).toPandas().set_index(["host", "bucket"])
    for host, m in random_matrix[["host", "m"]].itertuples(index=False):
        t = m * 60
        key = (host, minute(int(m)))
        earlier = [s for h, s in zip(hosts, secs) if h == host and s <= t]
        want = (t - max(earlier)) / 60 if earlier else 999999
        assert since.loc[key, "time_since_last_alarm"] == pytest.approx(want)
        assert free.loc[key, "time_since_last_alarm"] == pytest.approx(want)
        inside = [i for i, (h, s, n) in enumerate(zip(hosts, secs, lens)) if h == host and s <= t < s + n]
        assert flag.loc[key, "is_anomaly"] == int(bool(inside))
        assert first.loc[key, "y_true"] == int(bool(inside))
        assert first.loc[key, "anomaly"] == (f"l{inside[0] % 5}" if inside else "")


def test_window_comparison_against_brute_force(spark, random_matrix):
    rng = np.random.default_rng(4)
    pred = random_matrix.assign(y=(rng.random(len(random_matrix)) < 0.2).astype(int))
    p = spark.createDataFrame(
        [("m", h, minute(int(m)), int(y)) for h, m, y in pred[["host", "m", "y"]].itertuples(index=False)],
        "model string, host string, bucket timestamp_ntz, y_pred int",
    )
    wins = [(i, h, int(s), int(s + n)) for i, (h, s, n) in enumerate(zip(rng.choice(["a", "b", "z"], 40), rng.integers(0, 40000, 40), rng.integers(60, 20000, 40)))]
    at = lambda s: T0 + dt.timedelta(seconds=s)
    w = spark.createDataFrame([(i, h, at(a), at(b)) for i, h, a, b in wins], "id int, host string, start_ts timestamp_ntz, end_ts timestamp_ntz")
    got = intervals.detection_latency(intervals.compare_windows(p, w, window_key=["id", "host", "start_ts", "end_ts"])).toPandas().set_index("id")
    seen = 0
    for i, h, a, b in wins:
        inside = pred[(pred["host"] == h) & (pred["m"] * 60 >= a) & (pred["m"] * 60 < b)]
        if inside.empty:
            assert i not in got.index
            continue
        seen += 1
        hit = inside[inside["y"] == 1]["m"]
        assert got.loc[i, "rows_inside"] == len(inside) and got.loc[i, "detected_minutes"] == len(hit)
        assert got.loc[i, "caught"] == (len(hit) > 0)
        if len(hit):
            assert got.loc[i, "latency_min"] == int((hit.min() * 60 - a) / 60)
    assert seen == len(got)


def test_overlap_modes(spark):
    w = spark.createDataFrame(
        [(1, "h", minute(100), minute(200)), (2, "h", minute(400), minute(500)), (3, "h", minute(700), minute(705)), (4, "h", minute(900), minute(901))],
        "id int, host string, start_ts timestamp_ntz, end_ts timestamp_ntz",
    )
    # inside window 1; ends exactly at the start of 2; starts at the end of 3; none near 4
    a = spark.createDataFrame([("h", minute(150)), ("h", minute(390)), ("h", minute(705))], "host string, alarm_ts timestamp_ntz")
    over = {r["id"]: r["own_alarm_overlap"] for r in intervals.alarm_overlap(w, a).collect()}
    compat = {r["id"]: r["own_alarm_overlap"] for r in intervals.alarm_overlap(w, a, mode="compat").collect()}
    assert over == {1: True, 2: False, 3: False, 4: False}
    assert compat == {1: False, 2: False, 3: True, 4: False}


def test_forward_fill_is_limited_and_stays_in_its_chunk(spark):
    rows = [("h", minute(i), v) for i, v in enumerate([1.0, None, None, None, None, 2.0, None])]
    df = spark.createDataFrame(rows, "host string, bucket timestamp_ntz, x double")
    got = [r["x"] for r in matrix.forward_fill(df, ["x"], chunk=3600).orderBy("bucket").collect()]
    # a new chunk starts at 12:00, five rows later
    assert got == [1.0, 1.0, 1.0, 1.0, None, 2.0, 2.0]


@pytest.mark.parametrize("case", ["normal", "ties", "negative", "huge", "single"])
def test_quantiles(spark, case):
    rng = np.random.default_rng(5)
    x = {
        "normal": rng.normal(0, 1, 3000), "ties": rng.integers(0, 4, 3000).astype(float),
        "negative": -np.exp(rng.normal(0, 20, 1000)), "huge": np.array([1e300, -1e300, 1e-300, 0.0, 5.0]), "single": np.array([3.5]),
    }[case]
    df = spark.createDataFrame(pd.DataFrame({"g": "k", "x": np.append(x, np.nan)}))
    probs = [0.0, 0.25, 0.5, 0.99, 0.9995, 1.0]
    got = {r["prob"]: r["quantile"] for r in exact_quantiles(df, ["g"], "x", probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(x, p), rel=1e-12)


def test_correlation_and_selection(spark):
    rng = np.random.default_rng(6)
    a = rng.normal(50, 1, 500)
    pdf = pd.DataFrame({"a": a, "b": a * 2 + rng.normal(0, 0.01, 500), "c": rng.normal(0, 3, 500), "flat": 1.0, "d": rng.normal(0, 2, 500)})
    pdf.loc[rng.random(500) < 0.3, "c"] = np.nan
    pdf.loc[rng.random(500) < 0.3, "d"] = np.nan
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    want = pdf[["a", "b", "c", "d"]].corr().abs()
    for r in features.correlations(df, ["a", "b", "c", "d"]).collect():
        assert r["corr"] == pytest.approx(want.loc[r["feature_a"], r["feature_b"]], abs=1e-9)
    assert features.select_features(df, list(pdf.columns)) == ["a", "c", "d"]
    assert features.select_features(df, list(pdf.columns), top_k=2) == ["c", "d"]


def test_sequences_by_rows_and_by_time(spark, random_matrix):
    df = to_spark(spark, random_matrix).fillna(0.0)
    by_rows = rolling.sequences(df, ["x"], length=20, block=30).toPandas().set_index(["host", "bucket"])
    by_time = rolling.sequences(df, ["x"], length=20, block=30, by="time").toPandas().set_index(["host", "bucket"])
    clean = random_matrix.fillna(0.0)
    for host, group in clean.groupby("host"):
        m, x = group["m"].to_numpy(), group["x"].to_numpy()
        for i in range(len(m)):
            key = (host, minute(int(m[i])))
            if i < 19:
                assert key not in by_rows.index
            else:
                assert [v[0] for v in by_rows.loc[key, "sequence"]] == list(x[i - 19:i + 1])
            assert [v[0] for v in by_time.loc[key, "sequence"]] == list(x[(m > m[i] - 20) & (m <= m[i])])


def test_gaps(spark):
    df = spark.createDataFrame([("h", minute(m)) for m in (0, 10, 80, 151, 151, 3000)], "host string, bucket timestamp_ntz")
    got = sorted((r["gap_from"], r["gap_to"], r["minutes"]) for r in rolling.gaps(df).collect())
    assert got == [(minute(80), minute(151), 71.0), (minute(151), minute(3000), 2849.0)]


def test_fallback(spark):
    full, empty = spark.range(3), spark.range(0)
    other = spark.range(10, 12)
    assert asof.with_fallback(full, other).count() == 3
    assert sorted(r["id"] for r in asof.with_fallback(empty, other).collect()) == [10, 11]


def test_mixed_epoch_is_free_of_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = spark.createDataFrame([("2024-03-10 02:30:00",), ("1710037800",), ("x",)], "raw string")
    try:
        got = []
        for z in ("UTC", "America/New_York", "Europe/Istanbul"):
            spark.conf.set("spark.sql.session.timeZone", z)
            got.append([r[0] for r in df.select(tf.mixed_epoch(F.col("raw"))).collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == [[1710037800.0, 1710037800.0, None]] * 3
