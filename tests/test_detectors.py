"""Detectors must rank planted outliers first and be repeatable."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.functions import timeflow as tf
from pulsegrid.operators import audit, bundle, evaluate, rolling
from pulsegrid.operators.detectors import iforest, ocsvm, seqrecon
from pulsegrid.plans import retrain
from pulsegrid.session import materialize, work_path
from pulsegrid.suite import load

T0 = dt.datetime(2026, 1, 1)


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (1500, 4))
    x[:15] += np.array([6, -6, 6, -6])
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id int, x array<double>")


def auc(df):
    pdf = df.select("id", "score").toPandas()
    bad, good = pdf[pdf["id"] < 15]["score"].to_numpy(), pdf[pdf["id"] >= 15]["score"].to_numpy()
    return (bad[:, None] > good[None, :]).mean()


def test_isolation_forest(spark, planted):
    forest = materialize(iforest.fit(planted, "x", ["id"]), "forest")
    sizes = forest.where("node = 0").select("size").distinct().collect()
    assert [r["size"] for r in sizes] == [256] and forest.select("tree").distinct().count() == 300
    scored = iforest.score(planted, forest, "x", ["id"])
    assert auc(scored) > 0.99
    again = iforest.score(planted.repartition(5), materialize(iforest.fit(planted.repartition(7), "x", ["id"]), "forest"), "x", ["id"])
    diff = scored.alias("a").join(again.alias("b"), "id").agg(F.max(F.abs(F.col("a.score") - F.col("b.score")))).first()[0]
    assert diff < 1e-12


def test_forest_walk_is_the_plain_walk(spark, planted):
    """Scores by joins equal those of a walk over the stored nodes, row by row."""
    forest = materialize(iforest.fit(planted, "x", ["id"], trees=20, sample=64), "forest")
    nodes = {(r["tree"], r["node"]): r for r in forest.collect()}
    c = lambda n: 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + iforest.EULER) - 2 * (n - 1) / n
    some = planted.where("id % 50 = 0").unionByName(spark.createDataFrame([(9999, [None, float("nan"), 1.0, 0.0])], planted.schema))
    for r in some.join(iforest.score(some, forest, "x", ["id"], sample=64), "id").collect():
        total = 0.0
        for tree in range(20):
            node = 0
            while (at := nodes[tree, node])["feature"] >= 0:
                v = r["x"][at["feature"]]
                # Spark takes NaN as the greatest number; a missing value goes left
                node = 2 * node + 1 + int(v is not None and (np.isnan(v) or v > at["cut"]))
            total += at["depth"] + c(at["size"])
        assert abs(r["score"] - 2 ** (-total / 20 / c(64))) < 1e-9
    plan = iforest.score(some, forest, "x", ["id"], sample=64)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan


def test_newton_steps_reach_the_least_objective(spark, planted):
    """No step from the result in any of some directions lowers the objective."""
    _, model = ocsvm.descended(planted, "x", nu=0.1, dim=32)
    phi = model.features(np.array([r["x"] for r in planted.collect()]))

    def objective(w, rho):
        slack = np.maximum(0, rho - phi @ w)
        return w @ w / 2 - rho + (slack ** 2).sum() / (2 * 0.1 * len(phi))

    best, rng = objective(model.w, model.rho), np.random.default_rng(3)
    for _ in range(200):
        assert objective(model.w + rng.normal(0, 0.01, 32), model.rho + rng.normal(0, 0.01)) >= best - 1e-9


def test_one_class_boundary(spark, planted):
    model = ocsvm.fit(planted, "x", nu=0.05)
    scored = ocsvm.score(planted, model, "x")
    assert auc(scored) > 0.95
    outside = scored.agg(F.avg((F.col("score") > 0).cast("double"))).first()[0]
    assert abs(outside - 0.05) < 0.002


def test_sequence_reconstruction(spark):
    n = 600
    t = np.arange(n)
    x = np.stack([np.sin(t / 9), np.cos(t / 9)], 1) + np.random.default_rng(2).normal(0, 0.02, (n, 2))
    x[550] += [3, -3]
    df = spark.createDataFrame([("h", T0 + dt.timedelta(minutes=i), float(a), float(b)) for i, (a, b) in enumerate(x)],
                               "host string, bucket timestamp_ntz, a double, b double")
    seq = rolling.sequences(df, ["a", "b"], length=30, block=100)
    train = seq.where(F.col("bucket") < F.lit(T0 + dt.timedelta(minutes=500)).cast("timestamp_ntz"))
    scored = seqrecon.score(seq, seqrecon.fit(train, latent=6), 2)
    top = scored.orderBy(F.desc("score")).first()
    assert top["bucket"] == T0 + dt.timedelta(minutes=550)


def test_sequence_scores_where_windows_cover_every_row(spark, tmp_path):
    """Without a normal row all train rows are learned from (finding F6); a single normal one is learned from alone."""
    rng = np.random.default_rng(3)
    rows = [(5 * h + k, dt.datetime(2024, 1, 16) + dt.timedelta(hours=h), 5, key, 300.0 if key == "purchase" else float(rng.normal(50, 9)))
            for h in range(150) for k, key in enumerate(["click", "error", "purchase", "signup", "view"])]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    scores = load()[0]["seqrecon_scores"](spark, str(tmp_path)).toPandas()
    assert len(scores) == 150 - 59 and np.isfinite(scores["score"]).all() and scores["score"].nunique() > 80
    some = spark.createDataFrame([(0, 1), (1, 1), (2, 0)], "id int, y_true int")
    ids = lambda df: sorted(r["id"] for r in df.collect())
    assert ids(seqrecon.normal(some)) == [2] and ids(seqrecon.normal(some.where("y_true = 1"))) == [0, 1]


def test_components_span_the_leading_directions(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (400, 3)) @ rng.normal(0, 1, (3, 8)) + rng.normal(0, 0.01, (400, 8)) + 5
    parts = seqrecon.components(spark.createDataFrame([([float(v) for v in r],) for r in x], "x array<double>").repartition(5), "x", 3)
    centred = x - x.mean(axis=0)
    best = np.linalg.svd(centred, full_matrices=False)[2][:3].T
    assert np.allclose(parts.mean, x.mean(axis=0)) and np.allclose(parts.pc.T @ parts.pc, np.eye(3))
    assert np.allclose(parts.pc @ parts.pc.T, best @ best.T, atol=1e-6)


def test_metrics_on_zero_denominators(spark):
    rows = spark.createDataFrame([("m", 1.0, 0, 1), ("m", None, 1, 1), ("n", 1.0, 1, 1), ("n", 0.0, 0, 0)], "model string, score double, y_pred int, y_true int")
    got = {r["model"]: (r["precision"], r["recall"], r["f1"], r["n_pred_pos"]) for r in evaluate.prf(rows).collect()}
    assert got == {"m": (0.0, 0.0, 0.0, 0), "n": (1.0, 1.0, 1.0, 1)}


def test_vote_and_margin(spark):
    rows = spark.createDataFrame(
        [("h", T0, "a", 5.0, 3.0), ("h", T0, "b", 0.1, 0.6), ("h", T0, "c", None, 1.0)],
        "host string, bucket timestamp_ntz, model string, score double, threshold double",
    )
    r = evaluate.vote(rows).first()
    assert (r["n_models"], r["n_anomaly_models"], r["alert"], r["max_score"]) == (2, 1, True, 5.0)
    m = {x["model"]: x["active"] for x in evaluate.threshold_margin(rows, rows).collect()}
    assert m == {"a": 1, "b": 0}


def test_random_baseline_is_repeatable(spark):
    rows = spark.range(2000).select(F.col("id").alias("bucket"), F.lit("h").alias("host"), (F.col("id") % 10 == 0).cast("int").alias("y_true"))
    a = evaluate.random_baseline(rows).first()["best_f1"]
    b = evaluate.random_baseline(rows.repartition(9)).first()["best_f1"]
    assert a == b and 0.05 < a < 0.3


METRICS = ["system.cpu.util", "vm.memory.size[available]"]
SETTINGS = retrain.Settings(top_k=10, min_test_rows=300, trees=50, seq_len=30, block=300)
CUT = "2026-01-01 14:00:00"


@pytest.fixture(scope="module")
def monitored(spark):
    rng = np.random.default_rng(8)
    n = 1200
    cpu = 30 + 5 * np.sin(np.arange(n) / 40) + rng.normal(0, 0.5, n)
    cpu[1000:1030] += 40
    df = spark.createDataFrame(
        [("h", T0 + dt.timedelta(minutes=i), float(c), float(m)) for i, (c, m) in enumerate(zip(cpu, rng.normal(50, 1, n)))],
        "host string, bucket timestamp_ntz, `system.cpu.util` double, `vm.memory.size[available]` double",
    )
    win = spark.createDataFrame([("h", T0 + dt.timedelta(minutes=1000), T0 + dt.timedelta(minutes=1030), "cpu", 1)],
                                "host string, start_ts timestamp_ntz, end_ts timestamp_ntz, label string, seq_no int")
    return df, win


@pytest.fixture(scope="module")
def chained(spark, monitored):
    root = work_path(spark, "models")
    return root, retrain.chain(*[monitored[0], METRICS, monitored[1]], tf.ntz(CUT), root, "r1", SETTINGS)


def test_retrain_chain_finds_the_planted_window(chained):
    out = chained[1]
    assert out["gate"].first()["enough"]
    assert out["predictions"].where("y_true = 1").select("anomaly").distinct().first()["anomaly"] == "cpu"
    got = {r["model"]: r["recall"] for r in out["metrics"].collect()}
    assert set(got) == {"isolation_forest", "one_class", "sequence"}
    assert max(got.values()) > 0.8


def test_another_session_scores_alike(spark, chained):
    """A session that has only the folder gives the scores of the fit."""
    root, out = chained
    other = spark.newSession()
    rows = out["rows"].where("side = 'test'")
    again = retrain.score_rows(other, root, "r1", out["rows"]).where("side = 'test'")
    both = again.select("model", "host", "bucket", F.col("score").alias("again")).join(out["predictions"], ["model", "host", "bucket"], "full")
    r = both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.abs(F.col("again") - F.col("score")) < 1e-9).alias("same")).first()
    assert r["n"] == r["same"] == 3 * rows.count()
    assert bundle.runs(other, root) == ["r1"]


def test_half_a_bundle_is_none(spark, chained):
    with pytest.raises(FileNotFoundError):
        bundle.load(spark, chained[0], "r2")
    spark.range(1).write.parquet(f"{chained[0]}/run_id=r3/forest")
    assert bundle.runs(spark, chained[0]) == ["r1"]


def test_audit_lets_a_good_run_pass_and_stops_a_bad_one(spark, monitored, chained):
    root, out = chained
    verdict = {r["rule"]: r for r in out["audit"].collect()}
    assert all(r["passed"] for r in verdict.values() if r["blocking"]) and len(verdict) == 14
    assert bundle.active(spark, root) == "r1"
    # a run whose stored metrics are not what its models score
    made = retrain.run(monitored[0], METRICS, monitored[1], tf.ntz(CUT), SETTINGS, root=root, run_id="r4")
    made["metrics"].withColumn("precision", F.lit(0.4321)).write.parquet(f"{root}/odd")
    spark.read.parquet(f"{root}/odd").write.mode("overwrite").parquet(f"{root}/run_id=r4/metrics")
    bad = retrain.audited(made["rows"], monitored[1], METRICS, root, "r4", SETTINGS)
    with pytest.raises(Exception, match="audit failed: not_reproduced"):
        retrain.release(root, "r4", bad)
    assert bundle.active(spark, root) == "r1"


def test_windows_over_every_train_row(spark, monitored):
    """All three models are fitted, have thresholds and score again alike when no train row is normal (findings F2 to F5)."""
    root = work_path(spark, "covered")
    all_day = spark.createDataFrame([("h", T0, T0 + dt.timedelta(days=1), "all", 1)], monitored[1].schema)
    made = retrain.run(monitored[0], METRICS, all_day, tf.ntz(CUT), SETTINGS, root=root, run_id="r1")
    models = {"isolation_forest", "one_class", "sequence"}
    assert {r["model"]: r["n_test_rows"] for r in made["metrics"].collect()} == dict.fromkeys(models, 360)
    limit = {r["model"]: r["threshold"] for r in made["thresholds"].collect()}
    scores = retrain.score_rows(spark.newSession(), root, "r1", made["rows"]).where("model = 'sequence'").toPandas()
    train = scores[scores["side"] == "train"]["score"]
    assert set(limit) == models and len(train) == 840 - SETTINGS.seq_len + 1
    assert abs(limit["sequence"] - np.quantile(train, SETTINGS.seq_quantile)) < 1e-9
    stored = made["predictions"].where("model = 'sequence'").toPandas().sort_values("bucket")["score"].to_numpy()
    assert np.allclose(stored, scores[scores["side"] == "test"].sort_values("bucket")["score"], atol=1e-9)


def test_too_few_test_rows_stop_before_the_fit(spark, monitored):
    with pytest.raises(audit.NotEnoughRows):
        retrain.run(*[monitored[0], METRICS, monitored[1]], tf.ntz(CUT), retrain.Settings(block=300))
