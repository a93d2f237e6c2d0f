"""The training chain: split, gate, select, scale, fit, store, threshold, evaluate, audit, release."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions import timeflow as tf
from pulsegrid.functions.metrics import FORBIDDEN_FEATURES
from pulsegrid.operators import audit, bundle, evaluate, features, intervals, rolling
from pulsegrid.operators.detectors import iforest, ocsvm, seqrecon
from pulsegrid.session import materialize, settle, work_path


@dataclass(frozen=True)
class Settings:
    # Default quantiles, feature count, sequence length.
    thr_quantile: float = 0.99
    seq_quantile: float = 0.95
    top_k: int = 300
    seq_len: int = 60
    seq_by: str = "rows"  # "grid" for bundles that streams score with
    row_latent: int = seqrecon.LATENT
    impute: str = "mean"
    width: int = tf.MINUTE
    widths: Sequence[int] = (5, 30, 60)
    block: int = 1440
    min_test_rows: int = evaluate.MIN_TEST_ROWS
    trees: int = iforest.TREES
    ocsvm_steps: int = ocsvm.STEPS
    row_key: Sequence[str] = field(default=("host", "bucket"))


SCORED = ("host", "bucket", "side", "y_true", "anomaly")


def with_features(wide: DataFrame, metrics: Sequence[str], split: Column, s: Settings) -> tuple[DataFrame, list[str]]:
    """Rolling and calendar features of all rows, marked train or test.

    One pass serves both sides: frames look backward only, so a train row never
    sees a test row, and a test row sees the train rows before it."""
    rolled = rolling.rolling_stats(wide, metrics, width=s.width, widths=s.widths, block=s.block).drop(*metrics)
    cal = tf.calendar(F.col("bucket"))
    return rolled.withColumns({**cal, "side": evaluate.side_of(split)}), candidate_features(metrics, s)


def candidate_features(metrics: Sequence[str], s: Settings) -> list[str]:
    names = [f"{m}_{stat}_{w}m" for m in metrics for w in s.widths for stat in ("avg", "std", "trend")]
    return [*tf.calendar(F.col("bucket")), *names]


def fit(wide: DataFrame, metrics: Sequence[str], windows: DataFrame, split: Column, root: str, run_id: str,
        s: Settings = Settings()) -> dict[str, DataFrame]:
    """Fit all models on the train side and store them as a bundle of ``run_id``.

    Raises :class:`pulsegrid.operators.audit.NotEnoughRows` before any work when the
    test side is too small.  Returns the tables gate and features (all rows, with
    their truth); whatever is scored afterwards is scored by the stored bundle."""
    spark = wide.sparkSession
    gate = settle(evaluate.sufficiency(wide, split, s.min_test_rows), "gate")
    audit.require_rows(gate)
    table, candidates = with_features(wide, metrics, split, s)
    table = materialize(table, "features")
    train = table.where("side = 'train'")

    selected = features.select_features(train, candidates, top_k=s.top_k)
    known = {r["feature"]: r for r in features.scaler_stats(train, selected, s.impute).collect()}
    column = lambda name: [known[c][name] for c in selected]
    truth = intervals.first_window_label(table, windows, row_key=s.row_key, grid=s.width)
    rows = materialize(table.join(truth, list(s.row_key)), "labelled")
    x = bundle.vectors(rows, selected, column("mean"), column("scale"), s.impute, [*s.row_key, "side", "y_true"])
    x = materialize(x, "scaled")
    fit_rows = x.where("side = 'train'")

    boundary = ocsvm.fit(fit_rows, "x", nu=1.0 - s.thr_quantile, steps=s.ocsvm_steps)
    # A sequence repeats every value seq_len times.  All selected features are first
    # reduced to a few per row, sequences are built of these, and what the first
    # step loses counts in the score.
    row_parts = seqrecon.components(seqrecon.normal(fit_rows), "x", s.row_latent)
    keep = [*s.row_key, "side", "y_true"]
    sequences = bundle.reduced_sequences(x, row_parts, keep, seq_len=s.seq_len, seq_by=s.seq_by, width=s.width, block=s.block)
    own = sequences.where("side = 'train'")
    normal = materialize(own.where("y_true = 0").select("sequence"), "sequences")
    # as in seqrecon.normal, without storing sequences that are not learned from
    all_labelled = normal.isEmpty()
    sequence_parts = seqrecon.fit(materialize(own.select("sequence"), "sequences") if all_labelled else normal)

    forest = materialize(iforest.fit(fit_rows, "x", s.row_key, trees=s.trees), "forest")
    test = F.col("side") == "test"
    spec = rows.agg(F.min(F.when(test, F.col("bucket"))).alias("test_min"), F.max(F.when(test, F.col("bucket"))).alias("test_max")).select(
        F.lit(run_id).alias("run_id"), F.lit(s.impute).alias("impute"), F.lit(s.width).alias("width"),
        F.array(*map(F.lit, s.widths)).alias("widths"), F.lit(s.block).alias("block"), F.lit(s.seq_len).alias("seq_len"), F.lit(s.seq_by).alias("seq_by"),
        F.lit(iforest.SAMPLE).alias("sample"), F.lit(float(boundary.rho)).alias("rho"), split.alias("split"), "test_min", "test_max")
    models = bundle.Bundle(spec.first(), selected, column("mean"), column("std"), column("scale"), forest, boundary, row_parts, sequence_parts)
    scores = materialize(bundle.score(models, rows, SCORED), "scores")
    # labelled rows are left out of the sequence model's threshold, unless all are
    base = scores.where("side = 'train'" if all_labelled else "side = 'train' AND NOT (model = 'sequence' AND y_true = 1)")
    limits = evaluate.thresholds(base, [s.thr_quantile, s.seq_quantile]).where(
        F.col("prob") == F.when(F.col("model") == bundle.SEQUENCE, s.seq_quantile).otherwise(s.thr_quantile)
    )
    bundle.save(replace(models, thresholds=limits), root)
    return {"gate": gate, "rows": rows, "scores": scores}


def score_rows(spark: SparkSession, root: str, run_id: str, rows: DataFrame) -> DataFrame:
    """Scores of labelled feature rows by a stored bundle, as a stored table."""
    return materialize(bundle.score(bundle.load(spark, root, run_id), rows, SCORED), "scores")


def evaluated(spark: SparkSession, root: str, run_id: str, scores: DataFrame, span_of: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Predictions and metrics of a run on the test rows it was evaluated on, or on
    those of the run ``span_of``."""
    spec = bundle.read(spark, root, span_of or run_id, "spec")
    span = lambda c: spec.select(c).scalar()
    test = scores.where((F.col("side") == "test") & (F.col("bucket") >= span("test_min")) & (F.col("bucket") <= span("test_max")))
    predictions = evaluate.apply_thresholds(test, bundle.read(spark, root, run_id, "thresholds"))
    return predictions, evaluate.prf(predictions)


def run(wide: DataFrame, metrics: Sequence[str], windows: DataFrame, split: Column, s: Settings = Settings(), *,
        root: str | None = None, run_id: str | None = None) -> dict[str, DataFrame]:
    """Fit, store, score and evaluate.  Tables: gate, selected, scaler, thresholds,
    rows, predictions, metrics; the bundle, predictions and metrics stay below
    ``root``/run_id=... and can be scored again by any session.

    ``windows``: (host, start_ts, end_ts, label, seq_no)."""
    spark = wide.sparkSession
    root, run_id = root or work_path(spark, "models"), run_id or f"run_{uuid.uuid4().hex[:12]}"
    made = fit(wide, metrics, windows, split, root, run_id, s)
    predictions, found = evaluated(spark, root, run_id, made["scores"])
    predictions = _stored(predictions, root, run_id, "predictions")
    found = _stored(found, root, run_id, "metrics")
    read = lambda name: bundle.read(spark, root, run_id, name)
    return {
        "gate": made["gate"], "selected": read("features").select("position", "feature"), "scaler": read("features"),
        "thresholds": read("thresholds"), "rows": made["rows"], "predictions": predictions, "metrics": found,
    }


def _stored(df: DataFrame, root: str, run_id: str, name: str) -> DataFrame:
    path = bundle.folder(root, run_id, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def audited(rows: DataFrame, windows: DataFrame, metrics: Sequence[str], root: str, run_id: str, s: Settings = Settings(),
            forbidden: Sequence[str] = FORBIDDEN_FEATURES) -> DataFrame:
    """The rules of a stored run, whose models score ``rows`` again, against what it
    had stored and against the active run, scored on the same rows."""
    spark = rows.sparkSession
    spec = bundle.read(spark, root, run_id, "spec").first()
    split = F.lit(spec["split"]).cast("timestamp_ntz")
    _, now = evaluated(spark, root, run_id, score_rows(spark, root, run_id, rows))
    now = settle(now, "metrics")
    stored = spark.read.schema(now.schema).parquet(bundle.folder(root, run_id, "metrics"))
    current = bundle.active(spark, root)
    active = stored.where(F.lit(False))
    if current is not None and current != run_id:
        active = settle(evaluated(spark, root, current, score_rows(spark, root, current, rows), run_id)[1], "active")
    candidates = candidate_features(metrics, s)
    chosen = features.select_features(rows.where("side = 'train'"), candidates, top_k=s.top_k)
    selected = spark.createDataFrame([(c,) for c in chosen], "feature string")
    kept = bundle.read(spark, root, run_id, "features").select("feature")
    train, test = rows.where("side = 'train'"), rows.where("side = 'test'")
    shift = features.median_shift(rows, chosen, F.col("side") == "test")
    truth = test.select("host", "bucket", "y_true")
    return settle(audit.rules(
        train.select("bucket"), test.select("bucket"), split, windows=windows, selected=selected, spec=kept, top_k=kept.count(),
        forbidden=forbidden, shift=shift, metrics=now, stored=stored, active=active,
        baseline=evaluate.random_baseline(truth), least_rows=s.min_test_rows), "audit")


def release(root: str, run_id: str, verdict: DataFrame) -> None:
    """Make a run the active one, unless a blocking rule failed: then the write
    itself fails and the active run stays."""
    one = verdict.sparkSession.createDataFrame([(run_id,)], "run_id string")
    bundle.promote(audit.guarded(one, verdict), root)


def chain(wide: DataFrame, metrics: Sequence[str], windows: DataFrame, split: Column, root: str, run_id: str,
          s: Settings = Settings()) -> dict[str, DataFrame]:
    """The whole retrain job: gate, fit, evaluate, audit, release."""
    made = run(wide, metrics, windows, split, s, root=root, run_id=run_id)
    verdict = audited(made["rows"], windows, metrics, root, run_id, s)
    release(root, run_id, verdict)
    return {**made, "audit": verdict}
