"""Line dedup by site-relative frequency.

Within a host the pages that contain a line are divided by the pages of the
host; a line above the ratio is boilerplate of that site and is dropped from
all its pages.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.native import SPACES


def line_key(line: Column) -> Column:
    """128 bits that stand for a line."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(line, F.lit(1)).alias("b"))


def blank(line: Column) -> Column:
    return F.regexp_replace(line, SPACES, "") == ""


def boilerplate(df: DataFrame, row: str, host: str, lines: str, ratio: float, min_pages: int) -> DataFrame:
    """(host, a, b, pages, host_pages) of the lines to drop."""
    own = df.select(F.col(host).alias("host"), F.explode(F.transform(
        F.array_distinct(F.filter(lines, lambda x: ~blank(x))), line_key)).alias("k"))
    pages = own.groupBy("host", "k.a", "k.b").agg(F.count("*").alias("pages")).filter(F.col("pages") >= min_pages)
    totals = df.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("host_pages"))
    return (pages.join(totals, pages["host"].eqNullSafe(totals["host"]))
            .select(pages["host"], "a", "b", "pages", "host_pages")
            .filter(F.col("pages") > F.col("host_pages") * F.lit(ratio)))


def drop_site_lines(df: DataFrame, id_col: str, text_col: str, host: Column, lines: Column | None = None,
                    ratio: float = 0.1, min_pages: int = 5) -> DataFrame:
    """``df`` with the boilerplate lines of its host taken out of ``text_col``;
    adds ``n_lines`` and ``n_removed``.

    ``lines`` is the array of lines of a row, by default ``text_col`` split at
    line feeds.  Blank lines are never boilerplate.  A page counts once for a
    line however often it repeats it.  Hosts that have fewer than ``min_pages``
    pages lose nothing, since a share says nothing there.  A null host is a
    host of its own; a null text stays null and has no lines; rows may repeat,
    ids may be null or tied (equal ids share a set of lines, each line is
    judged by its host all the same); an empty table stays empty.  Other
    columns pass through, except ones named like the two added."""
    split = F.split(F.col(text_col), "\n", -1) if lines is None else lines
    rows = df.drop("n_lines", "n_removed")
    own = rows.select(F.col(id_col).alias("__id"), host.alias("__host"), split.alias("__lines"))
    bad = boilerplate(own, "__id", "__host", "__lines", ratio, min_pages)
    hits = own.select("__id", "__host", F.explode(F.transform(
        F.array_distinct(F.filter("__lines", lambda x: ~blank(x))), line_key)).alias("k"))
    hits = hits.select("__id", "__host", "k.a", "k.b")
    gone = hits.join(bad, hits["__host"].eqNullSafe(bad["host"]) & (hits["a"] == bad["a"]) & (hits["b"] == bad["b"])) \
        .select("__id", "__host", F.struct(hits["a"], hits["b"]).alias("k")) \
        .groupBy("__id", "__host").agg(F.collect_set("k").alias("__gone"))
    full = rows.withColumn("__h", host)
    joined = full.join(gone, F.col(id_col).eqNullSafe(gone["__id"]) & full["__h"].eqNullSafe(gone["__host"]), "left")
    kept = F.when(F.col("__gone").isNull(), split).otherwise(
        F.filter(split, lambda x: ~F.array_contains("__gone", line_key(x))))
    out = joined.withColumn("__kept", kept).withColumn("n_lines", F.coalesce(F.size(split), F.lit(0)).cast("long"))
    out = out.withColumn("n_removed", F.col("n_lines") - F.coalesce(F.size("__kept"), F.lit(0)).cast("long"))
    text = F.array_join("__kept", "\n")
    if lines is None:
        text = F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(text)
    return out.withColumn(text_col, text).select(*rows.columns, "n_lines", "n_removed")
