"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every end of ``links`` (a, b); the component is the
    least id that can be reached.

    Labels travel along links and then jump to the label of their label, so the
    rounds grow with the logarithm of the longest path.  Each round is a stored
    table; a much linked id costs rows in a splittable join, no collected list."""
    sym = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a != b").distinct()
    sym = materialize(sym, "links")
    labels = materialize(sym.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "id"), "labels")
    while True:
        near = sym.join(labels, sym["b"] == labels["id"]).groupBy(sym["a"].alias("id")).agg(F.min("label").alias("near"))
        pulled = materialize(labels.join(near, "id").select("id", "label", F.least("label", "near").alias("next")), "pulled")
        jump = pulled.select(F.col("id").alias("next"), F.col("next").alias("far"))
        after = materialize(pulled.join(jump, "next").select("id", "label", "far"), "labels")
        if after.filter("far != label").isEmpty():
            return labels.withColumnRenamed("label", "component")
        labels = after.select("id", F.col("far").alias("label"))
