"""Metric-key predicates and feature names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Key prefixes that mark a model metric, the marker of hourly
# roll-up columns, the non-metric columns, the rolling widths, the feature-name
# pattern, and the "no alarm yet" sentinel.
METRIC_PREFIXES = (
    "system.cpu", "vm.memory", "vfs.dev", "vfs.fs", "system.swap",
    "zabbix[process", "zabbix[preprocessing", "zabbix[vcache",
    "zabbix[rcache", "zabbix[tcache", "zabbix[wcache", "zabbix[vps",
)
HOURLY_MARK = "_hourly_"
META_COLUMNS = ("datetime_minute", "host")
ROLLING_WIDTHS = (5, 30, 60)
FEATURE_PATTERN = r"^(.*)_(avg|std|trend)_(\d+)m$"
NO_ALARM_YET = 999999
FORBIDDEN_FEATURES = ("datetime_minute", "host", "is_anomaly", "time_since_last_alarm")


def quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def named(column: str) -> Column:
    """A column by its plain name; metric keys hold dots, commas and brackets."""
    return F.col(quoted(column))


def metric_key(key: Column, prefixes=METRIC_PREFIXES) -> Column:
    starts = reduce(lambda a, b: a | b, [key.startswith(p) for p in prefixes])
    return starts & ~key.contains(HOURLY_MARK) & ~key.isin(*META_COLUMNS)


def metric_columns(columns, prefixes=METRIC_PREFIXES) -> list[str]:
    """The same rule for column names of a wide table."""
    return [
        c for c in columns
        if c.startswith(tuple(prefixes)) and HOURLY_MARK not in c and c not in META_COLUMNS
    ]


def has_host(host: Column) -> Column:
    return F.trim(host) != ""


def feature_name(key: Column, stat: Column, width: Column) -> Column:
    return F.format_string("%s_%s_%dm", key, stat, width)


def feature_parts(name: Column) -> dict[str, Column]:
    part = lambda i: F.nullif(F.regexp_extract(name, FEATURE_PATTERN, i), F.lit(""))
    return {"key_": part(1), "stat": part(2), "width": part(3).cast("int")}
