"""State of a stream that lives in tables: bounded history, batch by batch.

Every micro-batch writes its rows to a folder of its own in overwrite mode, so that
replaying a failed batch changes nothing.  After some batches the folders are merged
into one base that keeps only rows within the retention; the merged folders go.  A
base is used once it is complete, and it holds nothing of the batch that made it, so a
crash at any point leaves a state that the replay reads alike.  Neither rows nor
folders grow with the uptime.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions import timeflow as tf
from pulsegrid.operators.warehouse import listed, removed

DAY = "yyyy-MM-dd"


@dataclass(frozen=True)
class History:
    """Rows of the last ``keep`` seconds of event time, merged every ``every`` batches."""

    root: str
    schema: str
    keep: int
    time: str = "bucket"
    every: int = 8

    def _folders(self, spark: SparkSession) -> tuple[dict[int, str], dict[int, str]]:
        """Complete bases by the last batch in them, and batch folders."""
        found: dict[str, dict[int, str]] = {"base": {}, "batch": {}}
        for name in listed(spark, self.root):
            if m := re.fullmatch(r"(base|batch)-(\d+)", name):
                if m[1] == "batch" or "_SUCCESS" in listed(spark, f"{self.root}/{name}"):
                    found[m[1]][int(m[2])] = f"{self.root}/{name}"
        return found["base"], found["batch"]

    def put(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Store a batch's rows and give them back, read from the store."""
        path = f"{self.root}/batch-{batch_id}"
        rows.write.mode("overwrite").parquet(path)
        return rows.sparkSession.read.schema(self.schema).parquet(path)

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Rows of earlier batches; older ones than the retention may be missing."""
        bases, batches = self._folders(spark)
        upto = max((b for b in bases if b < batch_id), default=-1)
        paths = [bases[upto]] if upto >= 0 else []
        paths += [p for b, p in sorted(batches.items()) if upto < b < batch_id]
        return spark.read.schema(self.schema).parquet(*paths) if paths else spark.createDataFrame([], self.schema)

    def compact(self, spark: SparkSession, batch_id: int) -> None:
        """Merge all earlier batches when there are enough; call it before ``put``."""
        bases, batches = self._folders(spark)
        old = [b for b in batches if b < batch_id]
        if len(old) < self.every:
            return
        upto = max(old)
        if upto not in bases:
            rows = self.before(spark, batch_id)
            newest = rows.agg(F.max(self.time).alias("t")).scalar()
            kept = rows.where(F.col(self.time) >= tf.plus_seconds(newest, -self.keep))
            kept.hint("coalesce", 1).write.mode("overwrite").parquet(f"{self.root}/base-{upto}")
        for path in [p for b, p in bases.items() if b < upto] + [batches[b] for b in old]:
            removed(spark, path)


def put_day(rows: DataFrame, root: str, batch_id: int, time: str = "bucket") -> None:
    """Append a batch's rows to an output table by day; a replay replaces what the
    batch has written."""
    (
        rows.withColumns({"day": F.date_format(time, DAY), "batch_id": F.lit(batch_id).cast("long")}).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch_id").parquet(root)
    )


def days_of(spark: SparkSession, root: str, rows: DataFrame, schema: str, time: str = "bucket") -> DataFrame:
    """The output table on the days that ``rows``, a stored table, spans: only their
    folders are listed.  With the columns day and batch_id."""
    span = rows.agg(F.date_format(F.min(time), DAY).alias("lo"), F.date_format(F.max(time), DAY).alias("hi")).first()
    days = [n for n in listed(spark, root) if n.startswith("day=") and span["lo"] is not None and span["lo"] <= n[4:] <= span["hi"]]
    full = f"{schema}, day string, batch_id long"
    if not days:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", root).parquet(*[f"{root}/{d}" for d in days])
