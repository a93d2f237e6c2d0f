"""One-class boundary with an RBF kernel, as a linear problem.

Random Fourier features (Rahimi, Recht 2007) turn the RBF kernel into a dot
product of length ``DIM``.  The one-class objective (Schoelkopf et al. 2001), with
squared slack, is minimised by Newton steps: each is one pass over the rows that
adds up the Gram matrix of those inside the margin, DIM + 1 numbers squared.  A
handful of passes takes the place of many gradient steps.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.operators.dense import added_up, matrix
from pulsegrid.operators.quantiles import exact_quantiles
from pulsegrid.session import materialize

DIM = 256
STEPS = 12
SEED = 42
CLOSE = 1e-6

SCHEMA = "component int, weight double, phase double, frequency array<double>"


@dataclass(frozen=True)
class Boundary:
    """score(x) = rho - w . phi(x), phi(x) = sqrt(2 / DIM) cos(x W + b)."""

    w: np.ndarray
    rho: float
    freq: np.ndarray
    phase: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(2.0 / len(self.phase)) * np.cos(x @ self.freq + self.phase)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return self.rho - self.features(x) @ self.w

    def rows(self) -> list[tuple]:
        """Its parameters as rows of ``SCHEMA``; rho is kept apart."""
        return [(k, float(w), float(p), [float(v) for v in self.freq[:, k]]) for k, (w, p) in enumerate(zip(self.w, self.phase))]

    @classmethod
    def of(cls, rows, rho: float) -> Boundary:
        own = sorted(rows, key=lambda r: r["component"])
        column = lambda name: np.array([r[name] for r in own], dtype=float)
        return cls(column("weight"), rho, np.array([r["frequency"] for r in own], dtype=float).T, column("phase"))


def kernel_width(rows: DataFrame, features: str) -> tuple[int, float]:
    """(number of features F, 1 / (F * variance of all entries))."""
    total = lambda f: F.aggregate(features, F.lit(0.0), lambda acc, v: acc + f(v.cast("double")))
    per_row = rows.select(F.size(features).alias("f"), total(lambda v: v).alias("s"), total(lambda v: v * v).alias("q"))
    r = per_row.agg(F.max("f").alias("f"), F.sum("f").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).first()
    variance = r["q"] / r["n"] - (r["s"] / r["n"]) ** 2
    return r["f"], 1.0 / (r["f"] * variance) if variance > 0 else 1.0


def fit(rows: DataFrame, features: str, *, nu: float = 0.01, dim: int = DIM, steps: int = STEPS, seed: int = SEED) -> Boundary:
    """The boundary, moved along its normal until a share ``nu`` of the rows is outside."""
    train, model = descended(rows, features, nu=nu, dim=dim, steps=steps, seed=seed)
    margins = score(train, Boundary(model.w, 0.0, model.freq, model.phase), "x").select(F.lit(0).alias("k"), (-F.col("score")).alias("m"))
    rho = exact_quantiles(materialize(margins, "margins"), ["k"], "m", [nu]).first()["quantile"]
    return Boundary(model.w, float(rho), model.freq, model.phase)


def descended(rows: DataFrame, features: str, *, nu: float, dim: int = DIM, steps: int = STEPS, seed: int = SEED) -> tuple[DataFrame, Boundary]:
    """The stored train rows and the least of the objective
    w.w / 2 - rho + mean(max(0, rho - w.phi) ** 2) / (2 nu)."""
    train = materialize(rows.select(F.col(features).cast("array<double>").alias("x")), "one-class")
    f, gamma = kernel_width(train, "x")
    rng = np.random.default_rng(seed)
    model = Boundary(np.zeros(dim), 0.0, rng.normal(0.0, np.sqrt(2.0 * gamma), size=(f, dim)), rng.uniform(0.0, 2 * np.pi, dim))
    # start from the mean feature vector: the solution for nu = 1
    sums, _, n = _moments(train, model, everything=True)
    w = sums[:dim] / n
    at = np.append(w, float(w @ w))
    stay = np.append(np.ones(dim), 0.0)
    for _ in range(steps):
        model = Boundary(at[:dim], float(at[dim]), model.freq, model.phase)
        sums, gram, inside = _moments(train, model)
        if not inside:  # nothing within the margin: only a larger rho can help
            at = np.append(at[:dim], at[dim] + max(1e-3, abs(at[dim])))
            continue
        weight = 1.0 / (nu * n)
        slope = stay * at - np.eye(dim + 1)[dim] + weight * gram @ at
        step = np.linalg.solve(np.diag(stay) + weight * gram + 1e-9 * np.eye(dim + 1), slope)
        at = at - step
        if np.abs(step).max() < CLOSE * max(1.0, np.abs(at).max()):
            break
    return train, Boundary(at[:dim], float(at[dim]), model.freq, model.phase)


def _moments(rows: DataFrame, model: Boundary, everything: bool = False) -> tuple[np.ndarray, np.ndarray, int]:
    """Sum, Gram matrix and number of the vectors (phi, -1) of the rows within the
    margin, or of all rows."""
    dim = len(model.phase)

    def add(total: np.ndarray, batch) -> None:
        x = matrix(batch.column(0))
        phi = model.features(x)
        if not everything:
            phi = phi[phi @ model.w < model.rho]
        z = np.hstack([phi, np.full((len(phi), 1), -1.0)])
        total[0] += z.sum(axis=0)
        total[1:] += z.T @ z

    total = added_up(rows, add, (dim + 2, dim + 1))
    return total[0], total[1:], int(round(total[-1, -1]))


def score(rows: DataFrame, model: Boundary, features: str, out: str = "score") -> DataFrame:
    @F.pandas_udf("double")
    def boundary(vectors: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.stack(vectors.to_numpy()).astype(float)))

    return rows.withColumn(out, boundary(F.col(features)))
