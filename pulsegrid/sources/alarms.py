"""Alarms by day, with what earlier days left of them.

An hourly job must know the last alarm before its hour, however old.  Alarms are
stored by the day they were raised, and every day with alarms has one carry row per
host: its last alarm before that day.  An hour then reads its own day, the days since
the last one with alarms (there is at most that one), and that day's carry rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.operators import warehouse
from pulsegrid.session import materialize

DAY = "yyyy-MM-dd"
ALARMS = "eventid bigint, host string, alarm_ts timestamp_ntz, day string"
CARRY = "host string, alarm_ts timestamp_ntz, day string"


def _read(spark: SparkSession, path: str, schema: str, days: Sequence[str]) -> DataFrame:
    """The given days of a table, as far as it has them; no other folder is listed."""
    there = sorted(set(days) & set(warehouse.partitions(spark, path, "day")))
    if not there:
        return spark.createDataFrame([], schema)
    own = spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/day={d}" for d in there])
    return own.where(F.col("day").isin(*there))


def add(alarms: DataFrame, root: str) -> None:
    """Upsert alarms (eventid, host, alarm_ts), and carry them to the later days that
    the store has.  Late alarms are carried, too; repeating a call changes nothing."""
    spark = alarms.sparkSession
    new = materialize(alarms.select("eventid", "host", "alarm_ts", F.date_format("alarm_ts", DAY).alias("day")), "alarms")
    touched = sorted(r["day"] for r in new.select("day").distinct().collect())
    if not touched:
        return
    path, carry = f"{root}/alarms", f"{root}/carry"
    if warehouse.table_exists(spark, path):
        warehouse.upsert_partitions(spark, path, new, ["eventid", "host"], "day")
    else:
        new.hint("rebalance", "day").write.partitionBy("day").parquet(path)
    known = warehouse.partitions(spark, path, "day")
    later = [d for d in known if d >= touched[0]]
    before = [d for d in known if d < touched[0]][-1:]
    steps = _read(spark, path, ALARMS, [*before, *later]).groupBy("host", "day").agg(F.max("alarm_ts").alias("alarm_ts"))
    steps = steps.unionByName(_read(spark, carry, CARRY, before)).withColumn("target", F.lit(False))
    targets = steps.select("host").distinct().select("host", F.explode(F.array(*map(F.lit, later))).alias("day"), F.lit(True).alias("target"))
    # a host has one row per day here, not one per alarm
    rows = steps.unionByName(targets, allowMissingColumns=True)
    order = Window.partitionBy("host").orderBy("day", F.desc("target")).rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.withColumn("carried", F.max("alarm_ts").over(order)).where("target AND carried IS NOT NULL")
    stored = materialize(carried.select("host", F.col("carried").alias("alarm_ts"), "day"), "carry")
    stored.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(carry)


def between(spark: SparkSession, root: str, first: str, last: str) -> DataFrame:
    """(host, alarm_ts): all alarms of the days first..last, and each host's last one
    before them.  Enough for as-of lookups and open intervals of these days."""
    known = warehouse.partitions(spark, f"{root}/alarms", "day")
    start = max((d for d in known if d <= first), default=first)
    days = [d for d in known if start <= d <= last]
    rows = _read(spark, f"{root}/alarms", ALARMS, days).select("host", "alarm_ts")
    return rows.unionByName(_read(spark, f"{root}/carry", CARRY, [start]).select("host", "alarm_ts"))
