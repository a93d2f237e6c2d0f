"""Sources, sinks, chunks, upsert, ledger, archive."""

import datetime as dt
import glob
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulsegrid.functions import timeflow as tf
from pulsegrid.operators import matrix as matrix_ops
from pulsegrid.operators import reports, sketches, warehouse
from pulsegrid.plans import enrich
from pulsegrid.session import work_path
from pulsegrid.sources import alarms as alarm_days
from pulsegrid.sources import chunks, labels, monitoring, results

T0 = dt.datetime(2026, 1, 1)
HISTORY = "itemid bigint, clock bigint, value double, ns int"


def at(h, m=0):
    return dt.datetime(2026, 8, 19, h, m)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def matrix(spark):
    return spark.createDataFrame(
        [(at(10, i), "h1", 10.0 + i) for i in range(5)], "bucket timestamp_ntz, host string, `system.cpu.util` double"
    )


def test_feature_page(spark, matrix):
    page, total = reports.feature_page(matrix, limit=3, columns=["system.cpu.util"])
    assert page.count() == 3 and total.first()["total"] == 5
    assert page.columns == ["bucket", "host", "system.cpu.util"]
    assert reports.feature_page(matrix, limit=10_000)[0].count() == 5
    with pytest.raises(ValueError):
        reports.feature_page(matrix, limit=10**9)
    assert reports.feature_page(matrix, start=tf.ntz("2026-08-19 10:02:00"), end=tf.ntz("2026-08-19 10:03:00"))[0].count() == 2
    with pytest.raises(ValueError):
        reports.feature_page(matrix, columns=["nope"])


def test_upsert_replaces_whole_rows_and_is_idempotent(spark):
    old = spark.createDataFrame([("h", at(1), 1.0, 2.0), ("h", at(2), 3.0, 4.0)], "host string, bucket timestamp_ntz, a double, b double")
    new = spark.createDataFrame([("h", at(2), 9.0, 7.0)], "host string, bucket timestamp_ntz, a double, c double")
    once = warehouse.upsert(old, new, ["host", "bucket"])
    twice = warehouse.upsert(once, new, ["host", "bucket"])
    assert rows(once) == rows(twice) == [("h", at(1), 1.0, 2.0, None), ("h", at(2), 9.0, None, 7.0)]


def test_load_chunks_skips_marked_chunks_and_can_be_forced(spark):
    root = work_path(spark, "t-load")
    schema = "host string, bucket timestamp_ntz, x double, chunk_id string, day string"
    first = spark.createDataFrame([("h", at(1), 1.0, "c1", "d1"), ("h", at(2), 2.0, "c2", "d2")], schema)
    again = spark.createDataFrame([("h", at(1), 5.0, "c1", "d1"), ("h", at(3), 3.0, "c3", "d2")], schema)
    load = lambda df, **kw: rows(warehouse.load_chunks(spark, df, f"{root}/table", f"{root}/ledger", keys=["host", "bucket"], partition="day", **kw))
    assert load(first) == [("c1", 1), ("c2", 1)]
    assert load(first) == []
    assert load(again) == [("c3", 1)]
    table = lambda: rows(spark.read.parquet(f"{root}/table").select("bucket", "x"))
    assert table() == [(at(1), 1.0), (at(2), 2.0), (at(3), 3.0)]
    load(again, force=True)
    assert table() == [(at(1), 5.0), (at(2), 2.0), (at(3), 3.0)]
    assert spark.read.parquet(f"{root}/ledger").count() == 3


def test_ingest_and_validate(spark):
    root = work_path(spark, "t-ingest")
    hist = spark.createDataFrame([(1, 3600, 1.0, 0), (1, 3660, 2.0, 0)], HISTORY)
    empty = {"trends": "itemid bigint, clock bigint", "events": "eventid bigint", "problem": "eventid bigint"}
    read = lambda t: hist if t == "history" else spark.createDataFrame([], empty[t])
    dim = lambda t: spark.createDataFrame([(1,)], f"{t}_id int")
    assert chunks.ingest(read, dim, root, "chunk_3600_7200")
    status = {r["table_name"]: r["status"] for r in chunks.validate_files(spark, root, "chunk_3600_7200").collect()}
    assert status == {"history": "ok", "trends": "warning", "events": "warning", "problem": "warning",
                      "hosts": "ok", "items": "ok", "triggers": "ok", "functions": "ok"}
    status = {r["table_name"]: r["status"] for r in chunks.validate_files(spark, root, "chunk_0_1").collect()}
    assert status["history"] == "error"
    nothing = lambda t: spark.createDataFrame([], HISTORY if t == "history" else empty[t])
    assert not chunks.ingest(nothing, dim, root, "chunk_7200_9999")


def test_history_range_and_snapshots(spark):
    hist = spark.createDataFrame([(1, 100, 1.0, 0), (1, 200, 2.0, 0), (2, 150, 3.0, 0)], HISTORY)
    dims = {
        "hosts": spark.createDataFrame([(1, "h1", "H1", 0), (2, "h2", "H2", 3)], "hostid bigint, host string, name string, status int"),
        "items": spark.createDataFrame([(1, 1, "n", "system.cpu.util", 0, 0), (2, 1, "n", "k", 0, 1)],
                                       "itemid bigint, hostid bigint, name string, key_ string, value_type int, status int"),
        "triggers": spark.createDataFrame([(1, "e", "d", 1, 0)], "triggerid bigint, expression string, description string, priority int, status int"),
        "functions": spark.createDataFrame([(1, 1, 1, "f", "p")], "functionid bigint, itemid bigint, triggerid bigint, name string, parameter string"),
    }
    snap = monitoring.snapshots(dims.__getitem__)
    assert snap["hosts"].count() == 1 and snap["items"].count() == 1
    assert rows(monitoring.history_range(hist, snap["items"], 100, 200)) == [(1, 100, 1.0, 0)]


def test_windows_file(spark):
    path = work_path(spark, "t-windows")
    one = lambda *r: spark.createDataFrame([r], labels.WINDOW_SCHEMA)
    assert labels.append_windows(spark, path, one("a", "cpu", "h1", "spike", 10, 20, {"k": "v"}), "main") == 1
    assert labels.append_windows(spark, path, one("b", "cpu", None, None, 30, 40, None), "main") == 1
    assert labels.append_windows(spark, path, one("c", "cpu", "h1", "x", 30, 40, None), "main") == 0  # known identity
    assert labels.append_windows(spark, path, one("d", "cpu", "h1", "x", 50, 50, None), "main") == 0  # ends too early
    spark.createDataFrame([("not json",), ("",), ('{"type": "disk", "host": "", "start_ts": 5, "end_ts": 9}',)], "value string").write.mode("append").text(path)
    got = {(r["type"], r["host"], r["label"], r["start_ts"]) for r in labels.read_windows(spark, path, "main").collect()}
    assert got == {("cpu", "h1", "spike", 10), ("cpu", "main", "cpu", 30), ("disk", "main", "disk", 5)}
    assert labels.list_windows(labels.read_windows(spark, path, "main"), label="cpu").count() == 1
    assert labels.list_windows(labels.read_windows(spark, path, "main"), since=10).count() == 2


def test_results_of_all_runs(spark):
    root = work_path(spark, "t-runs")
    for run, f1 in (("r1", 0.2), ("r2", 0.6)):
        df = spark.createDataFrame([("m", 0.99, 1.5, 0.1, 0.2, f1, 3, 10, 0, 9, 20, 0, 19)], results.EVAL_SCHEMA)
        results.write_result(df, root, run, "eval")
    got = results.read_result(spark, root, "eval", results.EVAL_SCHEMA)
    assert {(r["run_id"], r["f1"]) for r in got.collect()} == {("r1", 0.2), ("r2", 0.6)}
    assert reports.best_model(got.withColumn("model", F.col("run_id"))).first()["model"] == "r2"


def test_notification(spark):
    alert = spark.createDataFrame([("h", "2026-08-19 10:00:00", "m", 5.0, 3.0)], "host string, datetime_minute string, model string, score double, threshold double")
    log = results.notifications(alert, F.lit("now"), F.create_map(F.lit("model"), F.lit("override"), F.lit("x"), F.lit("1")))
    body = log.select(F.from_json("payload", "map<string,string>").alias("p")).first()["p"]
    assert body == {"host": "h", "datetime_minute": "2026-08-19 10:00:00", "model": "override", "score": "5.0", "threshold": "3.0", "x": "1"}


def test_archive_keeps_what_is_recent(spark, matrix):
    a, k = work_path(spark, "t-archive"), work_path(spark, "t-keep")
    r = warehouse.archive_and_purge(spark, matrix, a, k, tf.ntz("2026-08-19 10:02:00")).first()
    assert (r["archived"], r["kept"], r["oldest_kept"]) == (2, 3, at(10, 2))


def test_archive_runs_do_not_replace_each_other(spark, matrix):
    a = work_path(spark, "t-archives")
    first = warehouse.archive_and_purge(spark, matrix, a, k := work_path(spark, "t-kept"), tf.ntz("2026-08-19 10:02:00")).first()
    second = warehouse.archive_and_purge(spark, spark.read.parquet(k), a, work_path(spark, "t-kept"), tf.ntz("2026-08-19 10:04:00")).first()
    assert (first["archived"], second["archived"], second["kept"]) == (2, 4, 1)


def test_upsert_reads_touched_partitions_only(spark):
    path = work_path(spark, "t-touched")
    schema = "host string, bucket int, x double, day string"
    spark.createDataFrame([("h", d, 1.0, f"d{d}") for d in range(4)], schema).write.partitionBy("day").parquet(path)
    before = {f: os.stat(f).st_ino for f in glob.glob(f"{path.removeprefix('file:')}/day=*/*.parquet")}
    warehouse.upsert_partitions(spark, path, spark.createDataFrame([("h", 2, 9.0, "d2")], schema), ["host", "bucket"], "day")
    after = {f: os.stat(f).st_ino for f in glob.glob(f"{path.removeprefix('file:')}/day=*/*.parquet")}
    assert {f for f in before if "day=d2" not in f} <= set(after)
    assert rows(spark.read.parquet(path).select("bucket", "x")) == [(0, 1.0), (1, 1.0), (2, 9.0), (3, 1.0)]


def test_silent_columns_do_not_make_rows_sparse(spark):
    quiet = "a double, b double, c double, d double, e double, f double"
    df = spark.createDataFrame([("h", at(10, i), 1.0, *[None] * 5, "c1") for i in range(3)] + [("h", at(11), *[1.0] * 6, "c2"), ("h", at(11, 1), 1.0, *[None] * 5, "c2")],
                               f"host string, bucket timestamp_ntz, {quiet}, chunk_id string")
    assert matrix_ops.drop_sparse_by(df, "chunk_id").groupBy("chunk_id").count().orderBy("chunk_id").collect() == [("c1", 3), ("c2", 1)]


def test_feature_matrix_job(spark):
    samples = spark.createDataFrame(
        [("h1", "cpu", at(10, i), float(i)) for i in range(6)] + [("h1", "mem", at(10, 0), 1.0), (" ", "cpu", at(10, 0), 9.0), (None, "cpu", at(10, 0), 9.0)],
        "host string, key_ string, ts timestamp_ntz, value double",
    )
    out = enrich.feature_matrix(samples, ["cpu", "mem"], share=1.0)
    # mem is carried over three rows; rows without it are too sparse
    assert rows(out.select("host", "bucket", "cpu", "mem")) == [("h1", at(10, i), float(i), 1.0) for i in range(4)]
    assert out.first()["chunk_id"] == f"chunk_{int(at(10).replace(tzinfo=dt.timezone.utc).timestamp())}_{int(at(11).replace(tzinfo=dt.timezone.utc).timestamp())}"


def _alarm_rows(spark, rows):
    return spark.createDataFrame([(i, h, T0 + dt.timedelta(hours=t)) for i, h, t in rows], "eventid bigint, host string, alarm_ts timestamp_ntz")


def test_alarm_days_read_one_day_and_one_carry(spark):
    root = work_path(spark, "t-alarms")
    rows = [(1, "a", 1), (2, "a", 30), (3, "b", 2), (4, "a", 100), (5, "b", 101), (6, "c", 200)]
    for part in (rows[:2], rows[3:5], rows[5:], rows[2:3], rows[2:3]):  # the last two: late, and repeated
        alarm_days.add(_alarm_rows(spark, part), root)
    for first, last in ((0, 0), (1, 1), (2, 2), (3, 4), (4, 4), (5, 7), (8, 8), (20, 21)):
        days = [(T0 + dt.timedelta(days=d)).strftime("%Y-%m-%d") for d in (first, last)]
        got = alarm_days.between(spark, root, *days)
        best = {}
        for r in got.collect():
            best.setdefault(r["host"], []).append((r["alarm_ts"] - T0).total_seconds() / 3600)
        for host in "abc":
            mine = [t for _, h, t in rows if h == host]
            inside = {t for t in mine if first * 24 <= t < (last + 1) * 24}
            before = max((t for t in mine if t < first * 24), default=None)
            assert inside <= set(best.get(host, []))
            assert max((t for t in best.get(host, []) if t < first * 24), default=None) == before, (first, host)
    one = alarm_days.between(spark, root, "2026-01-05", "2026-01-05")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [") == 2 and "2026-01-05" in plan and "2026-01-09" not in plan
    files = {f.split("day=")[1].split("/")[0] for f in one.inputFiles()}
    assert files == {"2026-01-05"}


def test_archive_moves_whole_days_once(spark):
    path, archive = work_path(spark, "t-days"), work_path(spark, "t-archive")
    rows = [(h, T0 + dt.timedelta(days=d)) for d in range(6) for h in ("a", "b", None)]
    df = spark.createDataFrame(rows, "host string, bucket timestamp_ntz").withColumn("day", F.date_format("bucket", "yyyy-MM-dd"))
    df.write.partitionBy("day").parquet(path)
    untouched = {f for f in spark.read.parquet(path).inputFiles() if "day=2026-01-05" in f}
    assert warehouse.archive_days(spark, path, archive, "2025-01-01").count() == 0
    assert {r["day"]: r["archived"] for r in warehouse.archive_days(spark, path, archive, "2026-01-03").collect()} == {"2026-01-01": 3, "2026-01-02": 3}
    assert warehouse.archive_days(spark, path, archive, "2026-01-04").count() == 1
    assert spark.read.parquet(path).count() == 9 and spark.read.parquet(archive).count() == 9
    assert untouched <= set(spark.read.parquet(path).inputFiles())


def test_sketches_of_days_merge_within_their_bound(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.lognormal(0, 2, 40_000), np.full(20_000, 3.0)])
    rows = spark.createDataFrame(pd.DataFrame({"m": "a", "i": np.arange(len(x)) % 9, "x": x})).select(
        "m", F.when(F.col("x") > 0, F.col("x")).alias("x"), tf.plus_seconds(tf.ntz("2026-01-01 00:00:00"), F.col("i") * tf.DAY).alias("bucket"))
    rows = rows.unionByName(spark.createDataFrame([("a", None), ("a", float("nan")), (None, 1.0)], "m string, x double").withColumn("bucket", tf.ntz("2026-01-01 00:00:00")))
    for size in (200, 4000):
        daily = sketches.daily(rows, ["m"], "x", size=size)
        assert daily.count() == 9
        for r in sketches.quantiles(daily.where("day < '2026-01-06'"), ["m"], [0.01, 0.5, 0.9, 0.999], size).collect():
            own = np.sort(x[np.arange(len(x)) % 9 < 5])
            assert r["n"] == len(own)
            low, high = np.searchsorted(own, r["quantile"], "left") / len(own), np.searchsorted(own, r["quantile"], "right") / len(own)
            assert low - r["rank_error"] <= r["prob"] <= high + r["rank_error"], r


def test_growing_columns_are_remembered(spark):
    path = work_path(spark, "t-columns")
    first = spark.createDataFrame([("a", T0, 1.0, "d1"), ("b", T0, 2.0, "d2")], "host string, bucket timestamp_ntz, x double, day string")
    first.write.partitionBy("day").parquet(path)
    assert warehouse.known_schema(spark, path) is None and warehouse.read_table(spark, path).count() == 2
    more = spark.createDataFrame([("a", T0, 5, "d1"), ("c", T0, 6, "d1")], "host string, bucket timestamp_ntz, y long, day string")
    warehouse.upsert_partitions(spark, path, more, ["host", "bucket"], "day")
    got = warehouse.read_table(spark, path)
    assert set(got.columns) == {"host", "bucket", "x", "y", "day"}
    assert sorted((r["host"], r["x"], r["y"], r["day"]) for r in got.collect()) == [("a", None, 5, "d1"), ("b", 2.0, None, "d2"), ("c", None, 6, "d1")]
    # known columns are not written again, and the folder is no data
    n = len(glob.glob(f"{path.removeprefix('file:')}/{warehouse.SCHEMA_FOLDER}/part-*"))
    warehouse.upsert_partitions(spark, path, first, ["host", "bucket"], "day")
    assert len(glob.glob(f"{path.removeprefix('file:')}/{warehouse.SCHEMA_FOLDER}/part-*")) == n
    assert spark.read.parquet(path).count() == 3
