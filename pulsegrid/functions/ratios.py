"""Small numeric expressions shared by reports and detectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b, NULL when b is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def ratio0(a: Column, b: Column) -> Column:
    return F.coalesce(ratio(a, b), F.lit(0.0))


def f1_score(precision: Column, recall: Column) -> Column:
    return ratio0(2 * precision * recall, precision + recall)


def zscore(x: Column, mean: Column, std: Column) -> Column:
    """(x - mean) / std, with a zero std taken as 1 as a scaler does."""
    return (x - mean) / F.when(std == 0, 1.0).otherwise(std)


def impute(x: Column, mean: Column, how: str = "mean") -> Column:
    if how not in ("mean", "zero"):
        raise ValueError(f"unknown imputation rule: {how}")
    clean = F.when(~F.isnan(x), x)
    return F.coalesce(clean, mean if how == "mean" else F.lit(0.0))
