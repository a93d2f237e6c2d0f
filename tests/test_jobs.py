"""Hour by hour equals a full rebuild, and repeating an hour changes nothing."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.plans import jobs
from pulsegrid.session import work_path
from pulsegrid.sources import labels

H = 3600
START = 491_000 * H


@pytest.fixture(scope="module")
def source(spark):
    rng = np.random.default_rng(11)
    n = 900
    clock = START + np.sort(rng.choice(3 * H, n, replace=False))
    hist = [(int(i), int(c), float(round(v, 2)), 0) for i, c, v in zip(rng.integers(1, 5, n), clock, rng.normal(20, 4, n))]
    tables = {
        "history": spark.createDataFrame(hist, "itemid bigint, clock bigint, value double, ns int"),
        "trends": spark.createDataFrame([(i, START + h * H, 60, 1.0, 2.0 + i, 3.0) for i in range(1, 5) for h in range(3)],
                                        "itemid bigint, clock bigint, num int, value_min double, value_avg double, value_max double"),
        "events": spark.createDataFrame([(1, 0, 0, 1, START + 1800, 0, 1, "p", 3), (2, 0, 0, 1, START + 2000, 0, 0, "ok", 3), (3, 0, 0, 9, START + 4000, 0, 1, "lost", 3)],
                                        "eventid bigint, source int, object int, objectid bigint, clock bigint, ns int, value int, name string, severity int"),
        "problem": spark.createDataFrame([], "eventid bigint, objectid bigint, clock bigint, r_eventid bigint, r_clock bigint, name string, severity int"),
        "hosts": spark.createDataFrame([(1, "h1", "H1", 0), (2, "h2", "H2", 0)], "hostid bigint, host string, name string, status int"),
        "items": spark.createDataFrame(
            [(1, 1, "n", "system.cpu.util", 0, 0), (2, 1, "n", "vm.memory.size[available]", 0, 0), (3, 2, "n", "system.cpu.util", 0, 0), (4, 2, "n", "agent.ping", 0, 0),
             *[(i, 1, "n", f"system.cpu.silent{i}", 0, 0) for i in range(10, 20)]],
            "itemid bigint, hostid bigint, name string, key_ string, value_type int, status int"),
        "triggers": spark.createDataFrame([(1, "e", "d", 1, 0)], "triggerid bigint, expression string, description string, priority int, status int"),
        "functions": spark.createDataFrame([(1, 1, 1, "f", "p")], "functionid bigint, itemid bigint, triggerid bigint, name string, parameter string"),
    }
    return tables


def test_hourly_runs_equal_a_rebuild(spark, source, monkeypatch):
    root = work_path(spark, "t-jobs")
    at = jobs.Layout(root, f"{root}/windows")
    labels.append_windows(spark, at.windows, spark.createDataFrame(
        [("w", "cpu", "h2", "spike", START + 5000, START + 5600, None)], labels.WINDOW_SCHEMA), "main")
    def run(hour, **kw):
        a, b = START + hour * H, START + (hour + 1) * H
        cut = lambda t: source[t].where((F.col("clock") >= a) & (F.col("clock") < b))
        return jobs.run_chunk(spark, at, cut, source.__getitem__, a, b, **kw)

    assert [run(h) for h in range(3)] == ["loaded"] * 3
    assert run(1) == "already loaded"
    assert run(1, force=True) == "loaded"
    assert run(7) == "no data"

    # a crash between load and enrichment: the retry does all of it
    crashed = jobs.Layout(work_path(spark, "t-crash"))
    a, b = START, START + H
    args = (lambda t: source[t].where((F.col("clock") >= a) & (F.col("clock") < b)), source.__getitem__, a, b)
    with monkeypatch.context() as m:
        m.setattr(jobs, "enrich_range", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.run_chunk(spark, crashed, *args)
    assert jobs.run_chunk(spark, crashed, *args) == "loaded"
    assert spark.read.parquet(crashed.enriched).count() == spark.read.parquet(crashed.matrix).count() > 0

    to = jobs.Layout(work_path(spark, "t-rebuild"))
    counts = {r["table_name"]: r["n_rows"] for r in jobs.rebuild(spark, at, to).collect()}
    assert counts["ledger"] == 3 and counts["matrix"] == counts["enriched"] > 250
    for table in ("matrix", "enriched"):
        hourly, full = (spark.read.parquet(getattr(x, table)).toPandas().set_index(["host", "bucket"]).sort_index() for x in (at, to))
        assert set(hourly.columns) == set(full.columns)
        assert hourly.index.equals(full.index)
        for c in full.columns:
            if full[c].dtype == float:
                np.testing.assert_allclose(hourly[c], full[c], atol=1e-9, err_msg=c)
            else:
                assert (hourly[c].astype(str) == full[c].astype(str)).all(), c
    got = spark.read.parquet(to.enriched)
    assert got.where("is_anomaly = 1").groupBy("host").count().count() == 2
    assert {c for c in got.columns if "agent" in c or "hourly" in c} == set()
    first = got.where("host = 'h1' AND time_since_last_alarm < 999999").agg(F.min("time_since_last_alarm")).first()[0]
    assert first == 0.0
