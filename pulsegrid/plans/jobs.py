"""The hourly chunk job and the full rebuild, as functions over folders.

A scheduler of the user's choice calls :func:`run_chunk` per hour; repeating a
call changes nothing.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions import timeflow as tf
from pulsegrid.functions.metrics import ROLLING_WIDTHS, metric_columns
from pulsegrid.operators import asof, matrix, reports, warehouse
from pulsegrid.plans import enrich
from pulsegrid.session import materialize
from pulsegrid.sources import alarms as alarm_days
from pulsegrid.sources import chunks, labels
from pulsegrid.sources.monitoring import EVENT_PROBLEM, EVENT_SOURCE

DAY_FORMAT = "yyyy-MM-dd"


@dataclass(frozen=True)
class Layout:
    root: str
    windows: str | None = None  # labelled windows, if there is such a file
    default_host: str = "main"

    def raw(self, table: str) -> str:
        return f"{self.root}/raw/{table}"

    @property
    def matrix(self) -> str:
        return f"{self.root}/matrix"

    @property
    def enriched(self) -> str:
        return f"{self.root}/enriched"

    def alarms(self, table: str) -> str:
        return f"{self.root}/alarms/{table}"

    @property
    def ledger(self) -> str:
        return f"{self.root}/ledger"


def dimension(spark: SparkSession, at: Layout, table: str) -> DataFrame:
    return spark.read.parquet(f"{at.raw(table)}/latest")


def metric_keys(facts: DataFrame) -> list[str]:
    """Distinct metric keys that report in the facts: the columns of the matrix.
    Items of the inventory that are silent, or hold text, make no columns."""
    return [r["key_"] for r in facts.select("key_").where("key_ IS NOT NULL").distinct().orderBy("key_").collect()]


def named_facts(spark: SparkSession, at: Layout, facts: DataFrame) -> DataFrame:
    items = dimension(spark, at, "items").select("itemid", "hostid", "key_")
    hosts = dimension(spark, at, "hosts").select("hostid", "host")
    joined = matrix.join_dimensions(facts, [(items, "itemid"), (hosts, "hostid")])
    return joined.withColumn("ts", tf.from_epoch(F.col("clock")))


def chunk_matrix(spark: SparkSession, at: Layout, which: Sequence[str] | None = None) -> DataFrame:
    """Matrix rows of the given raw chunks, or of all."""
    def facts(table: str) -> DataFrame | None:
        if not chunks.has_chunks(spark, at.raw(table)):
            return None
        df = chunks.read_chunks(spark, at.raw(table))
        return df if which is None else df.where(F.col("chunk_id").isin(*which))

    history, trends = named_facts(spark, at, facts("history")), facts("trends")
    rollups = None
    if trends is not None:
        trends = named_facts(spark, at, trends)
        rollups = matrix.pivot_rollups(trends, metric_keys(trends))
    wide = enrich.feature_matrix(history, metric_keys(history), rollups=rollups)
    return wide.withColumn("day", F.date_format("bucket", DAY_FORMAT))


def _alarm_links(spark: SparkSession, at: Layout) -> list:
    dims = {t: dimension(spark, at, t) for t in ("triggers", "functions", "items", "hosts")}
    return [
        (dims["triggers"].select("triggerid"), "objectid", "triggerid"),
        (dims["functions"].select(F.col("triggerid").alias("f_triggerid"), F.col("itemid").alias("f_itemid")), "triggerid", "f_triggerid"),
        (dims["items"].select("itemid", F.col("hostid").alias("i_hostid")), "f_itemid", "itemid"),
        (dims["hosts"].select("hostid", "host"), "i_hostid", "hostid"),
    ]


#: Alarm logs in order of preference, with the rows that are alarms.
ALARM_LOGS = {"events": f"source = {EVENT_SOURCE} AND value = {EVENT_PROBLEM}", "problem": "clock IS NOT NULL"}


def alarm_log(spark: SparkSession, at: Layout, table: str, which: Sequence[str] | None = None) -> DataFrame | None:
    """Alarm rows of a raw log, of the given chunks or of all; None without chunks."""
    if not chunks.has_chunks(spark, at.raw(table)):
        return None
    log = chunks.read_chunks(spark, at.raw(table))
    if which is not None:
        log = log.where(F.col("chunk_id").isin(*which))
    return matrix.keep_last(log, ["eventid"], ["chunk_id"]).where(ALARM_LOGS[table])


def resolved(spark: SparkSession, at: Layout, log: DataFrame) -> DataFrame:
    """(eventid, host, alarm_ts) of alarm rows whose host is known."""
    chain = asof.alarm_chain(log.select("eventid", "objectid", "clock"), _alarm_links(spark, at))
    once = asof.distinct_alarms(chain, "eventid", "host", "clock")
    return once.select("eventid", "host", tf.from_epoch(F.col("clock").cast("bigint")).alias("alarm_ts"))


def alarms(spark: SparkSession, at: Layout) -> DataFrame | None:
    """(host, alarm_ts) from the event log, or from the problem log when the
    event log gives none; None when there is neither."""
    found = [log for log in (alarm_log(spark, at, t) for t in ALARM_LOGS) if log is not None]
    if not found:
        return None
    columns = ["eventid", "objectid", "clock"]
    either = found[0].select(*columns) if len(found) == 1 else asof.with_fallback(*[f.select(*columns) for f in found])
    return resolved(spark, at, either).select("host", "alarm_ts")


def add_alarms(spark: SparkSession, at: Layout, which: Sequence[str]) -> None:
    """Bring the alarms of some chunks into the stores by day, one for each log.

    Hosts are resolved by the inventory of this moment; a rebuild resolves all
    alarms by its own."""
    for table in ALARM_LOGS:
        log = alarm_log(spark, at, table, which)
        if log is not None:
            log = materialize(log.select("eventid", "objectid", "clock"), "alarm-log")
            if not log.isEmpty():
                spark.range(1).write.mode("ignore").parquet(f"{at.alarms(table)}/seen")
                alarm_days.add(resolved(spark, at, log), at.alarms(table))


def alarms_between(spark: SparkSession, at: Layout, start: int, end: int) -> DataFrame | None:
    """What an hour needs of :func:`alarms`: its days and the last alarms before them."""
    if not any(chunks.has_chunks(spark, at.raw(t)) for t in ALARM_LOGS):
        return None
    table = "events" if warehouse.table_exists(spark, f"{at.alarms('events')}/seen") else "problem"
    first, last = (time.strftime("%Y-%m-%d", time.gmtime(t)) for t in (start, end))
    return alarm_days.between(spark, at.alarms(table), first, last)


def windows(spark: SparkSession, at: Layout) -> DataFrame | None:
    if at.windows is None or not warehouse.table_exists(spark, at.windows):
        return None
    return labels.read_windows(spark, at.windows, at.default_host).withColumns(
        {c: tf.from_epoch(F.col(c)) for c in ("start_ts", "end_ts")}
    )


def store(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """Upsert rows keyed (host, bucket) into a table partitioned by day."""
    if warehouse.table_exists(spark, path):
        warehouse.upsert_partitions(spark, path, rows, ["host", "bucket"], "day")
    else:
        rows.hint("rebalance", "day").write.partitionBy("day").parquet(path)
        warehouse.remember_schema(spark, path, rows.schema)


def enrich_range(spark: SparkSession, at: Layout, start: int, end: int) -> DataFrame:
    """Enriched rows of [start, end), computed from the stored matrix."""
    begin, stop = tf.from_epoch(F.lit(start)), tf.from_epoch(F.lit(end))
    reach = tf.plus_seconds(begin, -max(ROLLING_WIDTHS) * tf.MINUTE)
    stored = warehouse.read_table(spark, at.matrix).where(
        (F.col("day") >= F.date_format(reach, DAY_FORMAT)) & (F.col("day") <= F.date_format(stop, DAY_FORMAT))
    )
    out = enrich.enriched_range(stored, metric_columns(stored.columns), alarms_between(spark, at, start, end), windows(spark, at), begin, stop)
    return out.withColumn("day", F.date_format("bucket", DAY_FORMAT))


def run_chunk(spark: SparkSession, at: Layout, read_range: Callable[[str], DataFrame],
              read_dim: Callable[[str], DataFrame], start: int, end: int, force: bool = False) -> str:
    """Extract, validate, transform, load and enrich one chunk."""
    chunk = f"chunk_{start}_{end}"
    if not chunks.ingest(read_range, read_dim, f"{at.root}/raw", chunk):
        return "no data"
    errors = chunks.validate_files(spark, f"{at.root}/raw", chunk).where("status = 'error'").collect()
    if errors:
        raise ValueError(f"{chunk}: missing {sorted(r['table_name'] for r in errors)}")
    known = warehouse.read_or_empty(spark, at.ledger, "chunk_id string, row_count long")
    if not force and not known.where(F.col("chunk_id") == chunk).isEmpty():
        return "already loaded"
    add_alarms(spark, at, [chunk])
    warehouse.load_chunks(
        spark, chunk_matrix(spark, at, [chunk]), at.matrix, at.ledger,
        keys=["host", "bucket"], partition="day", force=force,
        then=lambda: store(spark, at.enriched, enrich_range(spark, at, start, end)),
    )
    return "loaded"


def rebuild(spark: SparkSession, at: Layout, to: Layout) -> DataFrame:
    """Matrix and enriched tables of ``to`` from all raw chunks of ``at``;
    returns the row counts."""
    for table in ALARM_LOGS:
        warehouse.removed(spark, to.alarms(table))
        log = alarm_log(spark, at, table)
        if log is not None and not log.isEmpty():
            spark.range(1).write.mode("ignore").parquet(f"{to.alarms(table)}/seen")
            alarm_days.add(resolved(spark, at, log), to.alarms(table))
    wide = chunk_matrix(spark, at)
    wide.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(to.matrix)
    warehouse.remember_schema(spark, to.matrix, wide.schema)
    stored = warehouse.read_table(spark, to.matrix)
    out = enrich.enriched(stored, metric_columns(stored.columns), alarms(spark, at), windows(spark, at))
    (
        out.withColumn("day", F.date_format("bucket", DAY_FORMAT)).hint("rebalance", "day")
        .write.mode("overwrite").partitionBy("day").parquet(to.enriched)
    )
    warehouse.ledger_entries(stored).write.mode("overwrite").parquet(to.ledger)
    return reports.table_counts({t: spark.read.parquet(getattr(to, t)) for t in ("matrix", "enriched", "ledger")})
