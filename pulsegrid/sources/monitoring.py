"""Range scans of the monitoring tables, from a database or from parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Statement timeout (seconds), page size and tries of one pull,
# status codes of monitored hosts and active items, problem-event codes.
STATEMENT_TIMEOUT_S = 15
FETCH_ROWS = 50_000
HOST_STATUSES = (0, 1)
ITEM_ACTIVE = 0
EVENT_SOURCE, EVENT_PROBLEM = 0, 1

FACT_COLUMNS = {
    "history": ("itemid", "clock", "value", "ns"),
    "trends": ("itemid", "clock", "num", "value_min", "value_avg", "value_max"),
    "events": ("eventid", "source", "object", "objectid", "clock", "ns", "value", "name", "severity"),
    "problem": ("eventid", "objectid", "clock", "r_eventid", "r_clock", "name", "severity"),
}
DIM_COLUMNS = {
    "hosts": ("hostid", "host", "name", "status"),
    "items": ("itemid", "hostid", "name", "key_", "value_type", "status"),
    "triggers": ("triggerid", "expression", "description", "priority", "status"),
    "functions": ("functionid", "itemid", "triggerid", "name", "parameter"),
}


def jdbc_reader(spark: SparkSession, url: str, properties: dict[str, str] | None = None) -> Callable[[str], DataFrame]:
    """Reader of whole small tables (the dimensions)."""
    def read(table: str) -> DataFrame:
        return _options(spark, url, properties).option("dbtable", table).load()
    return read


def jdbc_range(spark: SparkSession, url: str, table: str, start: int, end: int, *, partitions: int = 8,
               column: str = "clock", properties: dict[str, str] | None = None) -> DataFrame:
    """``[start, end)`` of a fact table, pulled in key ranges side by side.

    Each range is one bounded statement (timeout, fetch size), ``partitions``
    caps the load on the source, and failed pulls are retried by Spark's task
    retries.  Range predicates replace OFFSET paging, which re-reads all
    skipped rows."""
    bounds = [start + (end - start) * i // partitions for i in range(partitions + 1)]
    ranges = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(bounds, bounds[1:]) if a < b]
    options = {"queryTimeout": str(STATEMENT_TIMEOUT_S), "fetchsize": str(FETCH_ROWS), **(properties or {})}
    return spark.read.jdbc(url, table, predicates=ranges, properties=options)


def _options(spark, url, properties):
    return (
        spark.read.format("jdbc").option("url", url)
        .options(queryTimeout=STATEMENT_TIMEOUT_S, fetchsize=FETCH_ROWS, **(properties or {}))
    )


def in_range(df: DataFrame, time: str, start: Column | int, end: Column | int) -> DataFrame:
    """Half-open range, pushed down to the scan."""
    return df.where((F.col(time) >= start) & (F.col(time) < end))


def history_range(history: DataFrame, active_items: DataFrame, start, end, *, time: str = "clock",
                  item: str = "itemid", columns=FACT_COLUMNS["history"]) -> DataFrame:
    """Samples of active items.  The table is a parameter: float and integer
    histories have the same shape.  Also serves the hourly roll-ups."""
    hit = in_range(history, time, start, end).select(*columns)
    return hit.join(active_items.select(item), item, "left_semi")


def snapshot(df: DataFrame, columns, status: str | None = None, allowed=()) -> DataFrame:
    if status is not None:
        df = df.where(F.col(status).isin(*allowed))
    return df.select(*columns)


def snapshots(read: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
    """The four dimension snapshots, filtered as the pipeline uses them."""
    rules = {"hosts": ("status", HOST_STATUSES), "items": ("status", (ITEM_ACTIVE,))}
    return {
        name: snapshot(read(name), cols, *rules.get(name, (None, ()))) for name, cols in DIM_COLUMNS.items()
    }
