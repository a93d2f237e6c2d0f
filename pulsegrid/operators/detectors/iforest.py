"""Isolation forest (Liu, Ting, Zhou 2008) as a Spark job.

Trees are independent: every row draws its trees by hashing, each tree keeps
the rows with the smallest draws, and one group per tree (at most ``SAMPLE``
rows by definition of the method) grows it.  All draws are pieces of digests of
the row key or of the node, so a retried task, and any engine, draws the same.

A forest is a table of nodes, numbered as in a heap.  Scoring walks it level by
level with equality joins on (tree, node); nothing leaves the JVM.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from math import ceil, log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Number of trees, rows per tree, seed.
TREES = 300
SAMPLE = 256
SEED = 42
EULER = 0.5772156649015329

#: Draws are numbers below this prime.
DRAWS = (1 << 31) - 1
NODE_SCHEMA = "tree int, node int, feature int, cut double, size int, depth int"
FOREST_SCHEMA = f"{NODE_SCHEMA}, path double"


def average_path(n: Column) -> Column:
    """Mean depth of an unsuccessful search among n points."""
    long = F.lit(2.0) * (F.ln(n - F.lit(1)) + F.lit(EULER)) - F.lit(2.0) * (n - F.lit(1)) / n
    return F.when(n > 2, long).when(n == 2, F.lit(1.0)).otherwise(F.lit(0.0))


def tree_samples(rows: DataFrame, row_key: Sequence[str], trees: int = TREES, sample: int = SAMPLE, seed: int = SEED) -> DataFrame:
    """(tree, row) pairs, ``sample`` rows without replacement per tree.

    A row's draws are an arithmetic progression modulo a prime, with both of its
    numbers from one digest of the row key, so two trees sample independently.
    Rows pre-select themselves with about twice the needed chance, so that the
    per-tree ranking handles some hundreds of rows however large the table."""
    n = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    limit = F.least(F.lit(1.0), F.lit(2.0 * sample + 64) / n) * F.lit(float(DRAWS))
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in row_key]))
    number = lambda at: F.conv(F.substring("_h", at, 8), 16, 10).cast("bigint")
    draws = F.transform(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda t: F.struct(t.alias("tree"), ((F.col("_a") + t * F.col("_b")) % F.lit(DRAWS)).alias("draw")),
    )
    chosen = (
        rows.withColumn("_h", digest).withColumns({"_a": number(1), "_b": number(9), "_limit": limit})
        .withColumn("_d", F.explode(F.filter(draws, lambda d: d["draw"] < F.col("_limit"))))
    )
    order = Window.partitionBy("tree").orderBy("draw", *row_key)
    return (
        chosen.withColumns({"tree": F.col("_d.tree"), "draw": F.col("_d.draw")})
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= sample)
        .drop("_h", "_a", "_b", "_limit", "_d", "draw", "_rank")
    )


def fit(rows: DataFrame, features: str, row_key: Sequence[str], *, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED) -> DataFrame:
    """The forest as a table of nodes.  ``features`` is an array column.

    A node draws one of the features that vary in it and a cut between their
    least and greatest value.  A leaf has feature -1, and ``path`` is its depth
    plus the expected rest of the search among its rows."""
    deepest = _levels(sample)

    def grow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(pdf[features].to_numpy()).astype(float)
        nodes, todo = [], [(0, np.arange(len(x)), 0)]
        while todo:
            node, members, depth = todo.pop()
            low, high = x[members].min(axis=0), x[members].max(axis=0)
            usable = np.flatnonzero(high > low)
            if depth >= deepest or len(usable) == 0:
                nodes.append((key[0], node, -1, 0.0, len(members), depth))
                continue
            digest = hashlib.md5(f"{seed}|{key[0]}|{node}".encode()).hexdigest()
            f = int(usable[int(digest[:8], 16) % len(usable)])
            cut = float(low[f] + (high[f] - low[f]) * (int(digest[8:16], 16) / 4294967296.0))
            left = x[members, f] <= cut
            nodes.append((key[0], node, f, cut, len(members), depth))
            todo += [(2 * node + 1, members[left], depth + 1), (2 * node + 2, members[~left], depth + 1)]
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "cut", "size", "depth"])

    drawn = tree_samples(rows.select(*row_key, features), row_key, trees, sample, seed)
    grown = drawn.select("tree", features).groupBy("tree").applyInPandas(grow, NODE_SCHEMA)
    return grown.withColumn("path", F.when(F.col("feature") < 0, F.col("depth") + average_path(F.col("size"))))


def _levels(sample: int) -> int:
    return ceil(log2(max(sample, 2)))


def score(rows: DataFrame, forest: DataFrame, features: str, keep: Sequence[str], *, sample: int = SAMPLE, out: str = "score") -> DataFrame:
    """(keep..., score) with the anomaly score 2 ** (-mean path / c(sample)).

    ``keep`` identifies a row.  The forest is broadcast: it has at most trees x
    (2 * sample - 1) nodes whatever the data size.  A row meets the nodes of all
    trees in one stage and leaves it as one partial sum."""
    nodes = F.broadcast(forest.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), "feature", "cut", "path"))
    roots = forest.where("node = 0").agg(F.max("tree").alias("last"), F.least(F.lit(sample), F.max("size")).alias("size"))
    at = rows.select(*keep, F.col(features).alias("_x"), F.explode(F.sequence(F.lit(0), roots.select("last").scalar())).alias("_tree"))
    at = at.withColumn("_node", F.lit(0))
    here = lambda df: df.join(nodes, (F.col("_tree") == F.col("_t")) & (F.col("_node") == F.col("_n")))
    for _ in range(_levels(sample)):
        right = F.coalesce(F.get("_x", F.col("feature")) > F.col("cut"), F.lit(False)).cast("int")
        below = F.when(F.col("feature") < 0, F.col("_node")).otherwise(2 * F.col("_node") + 1 + right)
        at = here(at).select(*keep, "_x", "_tree", below.alias("_node"))
    norm = average_path(roots.select("size").scalar())
    walked = here(at).groupBy(*keep).agg(F.avg("path").alias("_path"))
    return walked.select(*keep, F.pow(F.lit(2.0), -F.col("_path") / F.when(norm > 0, norm).otherwise(1.0)).alias(out))
