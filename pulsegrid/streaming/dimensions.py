"""Names that change while a stream runs: versions of a dimension with validity.

A version is a row (itemid, key_, valid_from); publishing a snapshot appends only the
items whose name is new, so the table grows with renames.  A micro-batch reads the
versions of its moment and gives each row the name that was valid at its time, also
when an old bucket closes after a rename.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.operators.warehouse import read_or_empty

SCHEMA = "itemid bigint, key_ string, valid_from timestamp_ntz"


def publish(items: DataFrame, path: str, valid_from: Column) -> None:
    """Append the items of a snapshot (itemid, key_) that are new or renamed."""
    spark = items.sparkSession
    known = read_or_empty(spark, path, SCHEMA)
    latest = known.groupBy("itemid").agg(F.max_by("key_", "valid_from").alias("old"))
    changed = items.select("itemid", "key_").distinct().join(latest, "itemid", "left").where("old IS NULL OR old <> key_")
    changed.select(F.col("itemid").cast("bigint").alias("itemid"), "key_", valid_from.alias("valid_from")).coalesce(1).write.mode("append").parquet(path)


def versions(spark: SparkSession, path: str) -> DataFrame:
    """(itemid, key_, valid_from, valid_to): the first version of an item holds for all
    earlier times, too, and the last one has no end."""
    rows = read_or_empty(spark, path, SCHEMA)
    order = Window.partitionBy("itemid").orderBy("valid_from")
    first = F.row_number().over(order) == 1
    return rows.withColumn("valid_to", F.lead("valid_from").over(order)).withColumn("valid_from", F.when(~first, F.col("valid_from")))


def keyed(rows: DataFrame, known: DataFrame, time: str = "bucket", name: str = "name") -> DataFrame:
    """``rows`` with ``key_``, the name valid at ``time``; an unknown item keeps its
    display name."""
    k = known.select(F.col("itemid").alias("_item"), F.col("key_").alias("_key"), "valid_from", "valid_to")
    valid = (F.col("itemid") == F.col("_item")) & F.coalesce(F.col(time) >= F.col("valid_from"), F.lit(True)) & F.coalesce(
        F.col(time) < F.col("valid_to"), F.lit(True))
    return rows.join(k, valid, "left").withColumn("key_", F.coalesce("_key", name)).drop("_item", "_key", "valid_from", "valid_to")
