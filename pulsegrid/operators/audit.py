"""The audit of a run as one table of rules, and the gate that it puts in a plan.

A rule is a row (rule, offending, blocking, passed).  Rules that only inform or warn
are not blocking.  ``guarded`` puts the verdict into another table's plan: when a
blocking rule failed, whatever reads that table fails with the rules' names.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.operators import evaluate, features

#: Signals of quality that don't stop a run.
INFORMS = ("windows_before_split", "distribution_shift", "above_random")


class NotEnoughRows(ValueError):
    """Too few test rows: a run is skipped, nothing is wrong."""


def require_rows(gate: DataFrame) -> None:
    """Stop before anything is fitted when the test side is too small."""
    r = gate.first()
    if not r["enough"]:
        raise NotEnoughRows(f"{r['test_rows']} test rows are too few")


def rule(name: str, offending: Column, one: DataFrame) -> DataFrame:
    return one.select(F.lit(name).alias("rule"), offending.cast("long").alias("offending"))


def rules(train: DataFrame, test: DataFrame, split: Column, *, windows: DataFrame, selected: DataFrame, spec: DataFrame,
          top_k: int, forbidden: Sequence[str], shift: DataFrame, metrics: DataFrame, stored: DataFrame,
          active: DataFrame, baseline: DataFrame, least_rows: int = evaluate.MIN_TEST_ROWS) -> DataFrame:
    """All rules of a run.

    ``train``, ``test``: (bucket), ``windows``: (start_ts), ``selected``, ``spec``:
    (feature) as chosen now and as stored, ``shift``: (shifted), ``metrics``: what
    the stored models score now, ``stored``: what the run had stored, ``active``:
    the active run's, all (model, precision, recall, f1), ``baseline``: (best_f1)."""
    one = train.sparkSession.range(1)
    count = lambda df, condition: df.agg(F.count_if(condition).alias("n")).scalar()
    split_rules = evaluate.audit_split(train, test, split).select("rule", "offending")
    name_rules = features.feature_set_check(selected, spec, top_k, forbidden).select("rule", "offending")
    short = F.greatest(F.lit(least_rows) - test.agg(F.count(F.lit(1)).alias("n")).scalar(), F.lit(0))
    beaten = baseline.agg(F.max("best_f1").alias("f")).scalar()
    parts = [
        split_rules, name_rules,
        rule("test_rows_lacking", short, one),
        rule("windows_before_split", count(windows, F.col("start_ts") < split), one),
        rule("distribution_shift", count(shift, F.col("shifted")), one),
        rule("not_reproduced", count(evaluate.reconcile(metrics, stored), ~F.col("consistent")), one),
        rule("above_random", F.when(metrics.agg(F.max("f1").alias("f")).scalar() > beaten, 0).otherwise(1), one),
        rule("degraded", count(evaluate.degradation(metrics, active), F.col("degraded")), one),
    ]
    table = reduce(DataFrame.unionByName, parts)
    return table.withColumns({"blocking": ~F.col("rule").isin(*INFORMS), "passed": F.col("offending") == 0})


def guarded(df: DataFrame, rules: DataFrame) -> DataFrame:
    """``df``, whose rows fail to be read when a blocking rule failed."""
    broken = rules.where("blocking AND NOT passed").agg(F.array_sort(F.collect_list("rule")).alias("r")).scalar()
    stop = F.raise_error(F.concat(F.lit("audit failed: "), F.array_join(broken, ", "))).cast("boolean")
    return df.where(F.when(F.size(broken) > 0, stop).otherwise(F.lit(True)))
