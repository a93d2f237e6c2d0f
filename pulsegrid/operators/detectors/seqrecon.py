"""Sequence reconstruction: a linear autoencoder over the last steps.

The flattened window of a host is projected on its principal components
and back; the score is the mean squared error of the last step only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.operators.dense import added_up, matrix

LATENT = 16

SCHEMA = "position int, mean double, loading array<double>"


@dataclass(frozen=True)
class Parts:
    """Principal components: x is about mean + (x - mean) P P'."""

    mean: np.ndarray
    pc: np.ndarray

    def rows(self) -> list[tuple]:
        """Its parameters as rows of ``SCHEMA``."""
        return [(i, float(m), [float(v) for v in p]) for i, (m, p) in enumerate(zip(self.mean, self.pc))]

    @classmethod
    def of(cls, rows) -> Parts:
        own = sorted(rows, key=lambda r: r["position"])
        return cls(np.array([r["mean"] for r in own], dtype=float), np.array([r["loading"] for r in own], dtype=float))


def components(vectors: DataFrame, column: str, latent: int) -> Parts:
    """Leading eigenvectors of the covariance, from one pass that adds up a Gram
    matrix; its size depends on the length of a vector only.  Signs are fixed, so
    that a fit can be repeated."""
    rows = vectors.select(F.col(column).cast("array<double>").alias("x"))
    d = len(rows.first()["x"])

    def add(total: np.ndarray, batch) -> None:
        x = matrix(batch.column(0))
        total[0, :d] += x.sum(axis=0)
        total[0, d] += len(x)
        total[1:, :d] += x.T @ x

    total = added_up(rows, add, (d + 1, d + 1))
    n = total[0, d]
    mean = total[0, :d] / n
    covariance = (total[1:, :d] - n * np.outer(mean, mean)) / max(n - 1, 1)
    pc = np.linalg.eigh(covariance)[1][:, ::-1][:, :min(latent, d)]
    return Parts(mean, pc * np.where(pc[np.abs(pc).argmax(axis=0), np.arange(pc.shape[1])] < 0, -1.0, 1.0))


def normal(train: DataFrame, truth: str = "y_true") -> DataFrame:
    """The train rows that no window labels.  Where windows cover every row, there
    is no other behaviour to learn from: then it is all train rows."""
    own = train.where(F.col(truth) == 0)
    return train if own.isEmpty() else own


def flat(windows: DataFrame, sequence: str = "sequence") -> DataFrame:
    return windows.withColumn("_flat", F.flatten(F.col(sequence)))


def fit(windows: DataFrame, *, sequence: str = "sequence", latent: int = LATENT) -> Parts:
    """Components of the train windows.  Windows whose last step is labelled must
    be left out by the caller (:func:`normal`)."""
    return components(flat(windows, sequence), "_flat", latent)


def reduce_rows(rows: DataFrame, parts: Parts, features: str) -> DataFrame:
    """``rows`` with the principal components of their features as ``_latent{i}``,
    and ``_rest``, the squared length of what they leave."""
    k = parts.pc.shape[1]

    @F.pandas_udf("array<double>")
    def split(x: pd.Series) -> pd.Series:
        centred = np.stack(x.to_numpy()).astype(float) - parts.mean
        own = centred @ parts.pc
        rest = np.maximum(0.0, (centred ** 2).sum(axis=1) - (own ** 2).sum(axis=1))
        return pd.Series(list(np.hstack([own, rest[:, None]])))

    out = rows.withColumn("_parts", split(features))
    return out.select("*", *[F.col("_parts")[i].alias(f"_latent{i}") for i in range(k)], F.col("_parts")[k].alias("_rest")).drop("_parts")


def score(windows: DataFrame, parts: Parts, n_features: int, *, sequence: str = "sequence", out: str = "score") -> DataFrame:
    @F.pandas_udf("double")
    def last_step_error(vectors: pd.Series) -> pd.Series:
        x = np.stack(vectors.to_numpy()).astype(float) - parts.mean
        rebuilt = (x @ parts.pc) @ parts.pc[-n_features:].T
        return pd.Series(((x[:, -n_features:] - rebuilt) ** 2).mean(axis=1))

    return flat(windows, sequence).withColumn(out, last_step_error("_flat")).drop("_flat")
