"""Key ranges of a source pulled side by side, page by page, with a retry policy.

The source is any function that gives one page of a key range; a database cursor, a
paged service or a file reader.  Every range is one task, so the number of ranges
bounds the load.  A page that fails is asked for again after 2, 4, ... seconds; a
statement that ran into its time limit is not, because asking again would only add to
the load.  Pages follow the last key seen, so nothing is skipped over again.

A range that must be given up is reported as a row, not as a failed task: Spark would
run a failed task again, time-out or not.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from pulsegrid.session import materialize
from pulsegrid.sources.monitoring import FETCH_ROWS

# Fixed value: tries of one page.
ATTEMPTS = 3

#: (start, end, after, limit) -> rows with keys in [start, end) and above ``after``,
#: ordered by key, at most ``limit``; the key is the first column and unique.
Page = Callable[[int, int, int | None, int], Iterable[tuple]]


class PullFailed(RuntimeError):
    """Ranges could not be read; names them and why."""


class Expired(Exception):
    """What a page function raises for a statement that ran into its time limit."""


@dataclass
class KeyRange(InputPartition):
    start: int
    stop: int


@dataclass(frozen=True)
class Policy:
    page: int = FETCH_ROWS
    attempts: int = ATTEMPTS
    wait: float = 2.0
    expired: tuple[type[BaseException], ...] = (Expired, TimeoutError)

    def asked(self, fetch: Page, start: int, stop: int, after: int | None) -> list[tuple]:
        for attempt in range(1, self.attempts + 1):
            try:
                return list(fetch(start, stop, after, self.page))
            except self.expired:
                raise
            except Exception:
                if attempt == self.attempts:
                    raise
                time.sleep(self.wait ** attempt)
        raise AssertionError("unreachable")

    def rows(self, fetch: Page, start: int, stop: int) -> Iterator[tuple]:
        after = None
        while True:
            got = self.asked(fetch, start, stop, after)
            yield from got
            if len(got) < self.page:
                return
            after = got[-1][0]


def ranges(start: int, end: int, parts: int) -> list[KeyRange]:
    """[start, end) in at most ``parts`` ranges of about the same length."""
    bounds = [start + (end - start) * i // parts for i in range(parts + 1)]
    return [KeyRange(a, b) for a, b in zip(bounds, bounds[1:]) if a < b]


def source(name: str, fetch: Page, schema: str, policy: Policy = Policy()) -> type[DataSource]:
    """A data source ``name`` over ``fetch``; options start, end and parts.  Its rows
    have ``_failure`` after the columns of ``schema``: null, or why a range was given
    up, on a row without values."""
    columns = len(StructType.fromDDL(schema).fields)

    class Reader(DataSourceReader):
        def __init__(self, options: dict) -> None:
            self.start, self.end, self.parts = int(options["start"]), int(options["end"]), int(options.get("parts", 8))

        def partitions(self) -> list[KeyRange]:
            return ranges(self.start, self.end, self.parts)

        def read(self, partition: KeyRange) -> Iterator[tuple]:
            try:
                for row in policy.rows(fetch, partition.start, partition.stop):
                    yield (*row, None)
            except Exception as e:  # noqa: BLE001 reported as a row
                yield (*[None] * columns, f"[{partition.start}, {partition.stop}): {type(e).__name__}: {e}")

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return f"{schema}, _failure string"

        def reader(self, schema: StructType) -> Reader:
            return Reader(self.options)

    return Source


def pulled(spark: SparkSession, name: str, fetch: Page, schema: str, start: int, end: int, *, parts: int = 8,
           policy: Policy = Policy()) -> DataFrame:
    """All rows with keys in [start, end), stored.  Raises :class:`PullFailed` with
    the ranges that were given up; then nothing is returned."""
    if start >= end:
        return spark.createDataFrame([], schema)
    spark.dataSource.register(source(name, fetch, schema, policy))
    got = spark.read.format(name).options(start=start, end=end, parts=parts).load()
    stored = materialize(got, f"pull-{name}")
    failed = [r["_failure"] for r in stored.where(F.col("_failure").isNotNull()).select("_failure").collect()]
    if failed:
        raise PullFailed("; ".join(sorted(failed)))
    return stored.drop("_failure")

