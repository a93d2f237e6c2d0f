"""Fitted models as tables, and the one scorer that batch, audit and stream share.

A run's bundle is a folder of parquet tables with everything that scoring needs:
features with their scaler, forest nodes, boundary, principal components and
thresholds.  The spec is written last; a folder without it is not a bundle, so a
job that died half-way leaves nothing that could be loaded.  Sizes depend on the
number of features and trees, never on the data.

Promotions are an append-only table: the last one names the active run.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions import ratios
from pulsegrid.functions import timeflow as tf
from pulsegrid.functions.metrics import named
from pulsegrid.operators import rolling
from pulsegrid.operators.detectors import iforest, ocsvm, seqrecon
from pulsegrid.operators.warehouse import table_exists

FOREST, ONE_CLASS, SEQUENCE = "isolation_forest", "one_class", "sequence"
SCHEMAS = {
    "features": "position int, feature string, mean double, std double, scale double",
    "forest": iforest.FOREST_SCHEMA,
    "boundary": ocsvm.SCHEMA,
    "row_parts": seqrecon.SCHEMA,
    "sequence_parts": seqrecon.SCHEMA,
    "thresholds": "model string, prob double, threshold double",
    "spec": "run_id string, impute string, width int, widths array<int>, block int, seq_len int, seq_by string, sample int, rho double, "
            "split timestamp_ntz, test_min timestamp_ntz, test_max timestamp_ntz",
}
PROMOTED = "run_id string, position long"


@dataclass(frozen=True)
class Bundle:
    """A run's models.  ``forest`` and ``thresholds`` stay tables; the rest are
    parameters whose number depends on the features only."""

    spec: Row
    features: list[str]
    mean: np.ndarray
    std: np.ndarray
    scale: np.ndarray
    forest: DataFrame
    boundary: ocsvm.Boundary
    row_parts: seqrecon.Parts
    sequence_parts: seqrecon.Parts
    thresholds: DataFrame | None = None


def folder(root: str, run_id: str, table: str) -> str:
    return f"{root}/run_id={run_id}/{table}"


def save(models: Bundle, root: str) -> None:
    """Write all tables of a bundle; the spec comes last and makes it one."""
    spark, run_id = models.forest.sparkSession, models.spec["run_id"]
    scaler = zip(models.features, models.mean, models.std, models.scale)
    rows = {
        "features": [(i, f, float(m), float(d), float(c)) for i, (f, m, d, c) in enumerate(scaler)],
        "boundary": models.boundary.rows(), "row_parts": models.row_parts.rows(), "sequence_parts": models.sequence_parts.rows(),
        "spec": [models.spec],
    }
    stored = {"forest": models.forest, "thresholds": models.thresholds}
    for name in [*[n for n in SCHEMAS if n != "spec"], "spec"]:
        df = stored[name] if name in stored else spark.createDataFrame(rows[name], SCHEMAS[name])
        columns = [c.name for c in spark.createDataFrame([], SCHEMAS[name]).schema]
        df.select(*columns).coalesce(1).write.mode("overwrite").parquet(folder(root, run_id, name))


def read(spark: SparkSession, root: str, run_id: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(folder(root, run_id, table))


def load(spark: SparkSession, root: str, run_id: str) -> Bundle:
    if not table_exists(spark, f"{folder(root, run_id, 'spec')}/_SUCCESS"):
        raise FileNotFoundError(f"no complete bundle of run {run_id} below {root}")
    table = lambda name: read(spark, root, run_id, name)
    spec = table("spec").first()
    scaler = sorted(table("features").collect(), key=lambda r: r["position"])
    column = lambda name: np.array([r[name] for r in scaler], dtype=float)
    return Bundle(
        spec, [r["feature"] for r in scaler], column("mean"), column("std"), column("scale"), table("forest"),
        ocsvm.Boundary.of(table("boundary").collect(), spec["rho"]), seqrecon.Parts.of(table("row_parts").collect()),
        seqrecon.Parts.of(table("sequence_parts").collect()), table("thresholds"),
    )


def runs(spark: SparkSession, root: str) -> list[str]:
    """Runs with a complete bundle."""
    if not table_exists(spark, f"{root}/run_id=*/spec/_SUCCESS"):
        return []
    spec = spark.read.schema(SCHEMAS["spec"]).parquet(f"{root}/run_id=*/spec")
    return sorted(r["run_id"] for r in spec.select("run_id").distinct().collect())


def promote(run: DataFrame, root: str) -> None:
    """Append the one-row table ``run`` (run_id) to the promotions.  When the plan of
    ``run`` holds a gate (:func:`pulsegrid.operators.audit.guarded`) that fails,
    nothing is appended."""
    spark = run.sparkSession
    known = promotions(spark, root)
    following = F.coalesce(known.agg(F.max("position").alias("p")).scalar() + 1, F.lit(0).cast("long"))
    run.select("run_id", following.alias("position")).coalesce(1).write.mode("append").parquet(f"{root}/promoted")


def promotions(spark: SparkSession, root: str) -> DataFrame:
    if not table_exists(spark, f"{root}/promoted"):
        return spark.createDataFrame([], PROMOTED)
    return spark.read.schema(PROMOTED).parquet(f"{root}/promoted")


def active(spark: SparkSession, root: str) -> str | None:
    """The run promoted last; None before the first promotion."""
    return promotions(spark, root).agg(F.max_by("run_id", "position").alias("r")).first()["r"]


def vectors(rows: DataFrame, names: Sequence[str], mean: Sequence[float], scale: Sequence[float], impute: str,
            keep: Sequence[str], out: str = "x") -> DataFrame:
    """(keep..., x): imputed and scaled features as one array."""
    def scaled(name: str, m: float, s: float) -> Column:
        return (ratios.impute(named(name).cast("double"), F.lit(float(m)), impute) - F.lit(float(m))) / F.lit(float(s))

    return rows.select(*keep, F.array(*[scaled(c, m, s) for c, m, s in zip(names, mean, scale)]).alias(out))


def reduced_sequences(rows: DataFrame, parts: seqrecon.Parts, keep: Sequence[str], *, seq_len: int, seq_by: str, width: int, block: int) -> DataFrame:
    """Sequences of the last rows' principal components, with what the last row
    leaves of its features (``_rest``)."""
    short = seqrecon.reduce_rows(rows, parts, "x")
    lead = [f"_latent{i}" for i in range(parts.pc.shape[1])]
    return rolling.sequences(short.select(*keep, "_rest", *lead), lead, length=seq_len, by=seq_by, width=width, block=block)


def sequence_scores(sequences: DataFrame, parts: seqrecon.Parts, latent: int, n_features: int) -> DataFrame:
    """Both parts of a row's error are orthogonal, so their squares add up."""
    scored = seqrecon.score(sequences, parts, latent)
    return scored.withColumn("score", (F.col("score") * latent + F.col("_rest")) / n_features)


def score(bundle: Bundle, rows: DataFrame, keep: Sequence[str] = ("host", "bucket"), wanted: Column | None = None) -> DataFrame:
    """(model, keep..., score) of feature rows under all models of a bundle.

    ``rows`` has the bundle's features as columns and is read three times: hand
    over a stored table.  ``keep`` identifies a row and includes host and bucket.
    ``wanted``, over ``keep``, says which rows to score; the others are only history.
    Rows without a full sequence have no score of the sequence model."""
    s = bundle.spec
    wanted = F.lit(True) if wanted is None else wanted
    x = vectors(rows, bundle.features, bundle.mean, bundle.scale, s["impute"], keep)
    latent = bundle.row_parts.pc.shape[1]
    sequences = reduced_sequences(x, bundle.row_parts, keep, seq_len=s["seq_len"], seq_by=s["seq_by"],
                                  width=s["width"], block=s["block"])
    scored = {
        FOREST: iforest.score(x.where(wanted), bundle.forest, "x", keep, sample=s["sample"]),
        ONE_CLASS: ocsvm.score(x.where(wanted), bundle.boundary, "x"),
        SEQUENCE: sequence_scores(sequences.where(wanted), bundle.sequence_parts, latent, len(bundle.features)),
    }
    return reduce(DataFrame.unionByName, [df.select(F.lit(m).alias("model"), *keep, "score") for m, df in scored.items()])


def reach(bundle: Bundle) -> int:
    """Buckets of history that a row's scores look back to."""
    return bundle.spec["seq_len"] - 1 + max(bundle.spec["widths"]) - 1


def reach_start(bundle: Bundle, first: Column) -> Column:
    return tf.plus_seconds(first, -reach(bundle) * bundle.spec["width"])
