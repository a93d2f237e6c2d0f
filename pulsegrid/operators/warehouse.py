"""Upsert, ledger, archive and rebuild on plain parquet tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from pulsegrid.functions import timeflow as tf


#: Below a table's folder; Spark's readers pass over names that begin like this.
SCHEMA_FOLDER = "_columns"


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whole-row replace: a matched row is the new row, and columns only the
    old table has become NULL there; unmatched rows of both sides stay."""
    return old.join(new.select(*keys), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def evolve_union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def remember_schema(spark: SparkSession, path: str, schema: StructType) -> StructType:
    """Keep the columns of a growing table next to its files, so that readers need
    not open every file's footer.  Columns are only added; returns all known ones."""
    kept = known_schema(spark, path)
    known = {f.name for f in kept.fields} if kept else set()
    more = [StructField(f.name, f.dataType, True) for f in schema.fields if f.name not in known]
    if kept is not None and not more:
        return kept
    every = StructType([*(kept.fields if kept else []), *more])
    row = spark.createDataFrame([(len(every.fields), every.json())], "columns int, json string")
    row.coalesce(1).write.mode("append").parquet(f"{path}/{SCHEMA_FOLDER}")
    return every


def known_schema(spark: SparkSession, path: str) -> StructType | None:
    """The remembered columns of a table; None where nothing was remembered."""
    if not table_exists(spark, f"{path}/{SCHEMA_FOLDER}"):
        return None
    rows = spark.read.schema("columns int, json string").parquet(f"{path}/{SCHEMA_FOLDER}")
    return StructType.fromJson(json.loads(rows.agg(F.max_by("json", "columns").alias("j")).first()["j"]))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A growing table by its remembered columns; one that has none is read with the
    columns of all its files."""
    schema = known_schema(spark, path)
    return spark.read.option("mergeSchema", True).parquet(path) if schema is None else spark.read.schema(schema).parquet(path)


def upsert_partitions(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str],
                      partition: str) -> None:
    """Upsert into a table on disk, rewriting only the partitions that ``new``
    touches.  The merged partitions go to a side path first: a table cannot be
    overwritten while it is read, and a lost executor must not lose rows.

    Partitions are replaced one after the other: a failure in between leaves some of
    them new and some old until the same call is made again, which is harmless."""
    from pulsegrid.session import materialize

    # A batch touches few partitions; as literals they prune the scan.
    touched = [r[0] for r in new.select(partition).distinct().collect()]
    stored = read_table(spark, path)
    stored = stored.withColumn(partition, F.col(partition).cast(new.schema[partition].dataType)).where(F.col(partition).isin(touched))
    merged = materialize(upsert(stored, new, keys), "upsert")
    remember_schema(spark, path, merged.schema)
    (
        merged.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition).parquet(path)
    )


def pending(chunks: DataFrame, ledger: DataFrame, key: str = "chunk_id", force: bool = False) -> DataFrame:
    """Rows of chunks the ledger has not marked; all rows when forced."""
    return chunks if force else chunks.join(ledger.select(key), key, "left_anti")


def ledger_entries(loaded: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Entries to add after a successful load; an empty chunk yields none."""
    return loaded.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))


def load_chunks(spark: SparkSession, chunks: DataFrame, table: str, ledger: str, *,
                keys: Sequence[str], partition: str, key: str = "chunk_id", force: bool = False,
                then: Callable[[], None] | None = None) -> DataFrame:
    """Load chunks that are not in the ledger, run ``then``, and mark them.

    Marking comes last, after everything that is derived from the chunk: a
    failure in between re-loads it, and the upsert makes that harmless.  Returns
    the new ledger entries."""
    from pulsegrid.session import materialize

    todo = materialize(pending(chunks, read_or_empty(spark, ledger, f"{key} string, row_count long"), key, force), "load")
    if table_exists(spark, table):
        upsert_partitions(spark, table, todo, keys, partition)
    else:
        todo.hint("rebalance", partition).write.partitionBy(partition).parquet(table)
        remember_schema(spark, table, todo.schema)
    if then is not None and not todo.isEmpty():
        then()
    added = ledger_entries(todo, key)
    known = read_or_empty(spark, ledger, f"{key} string, row_count long")
    fresh = materialize(added.join(known.select(key), key, "left_anti"), "ledger")
    fresh.write.mode("append").parquet(ledger)
    return fresh


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def table_exists(spark: SparkSession, path: str) -> bool:
    """Is there anything at ``path``, which may be a glob pattern?"""
    fs, hadoop = _fs(spark, path)
    found = fs.globStatus(hadoop)
    return found is not None and len(found) > 0


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder; none when it does not exist."""
    fs, hadoop = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop)) if fs.exists(hadoop) else []


def removed(spark: SparkSession, path: str) -> None:
    fs, hadoop = _fs(spark, path)
    fs.delete(hadoop, True)


def partitions(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the partition column that a table on disk has."""
    mark = f"{column}="
    return [n[len(mark):] for n in listed(spark, path) if n.startswith(mark)]


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if table_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def archive_and_purge(spark: SparkSession, table: DataFrame, archive_path: str, keep_path: str,
                      cutoff: Column, time: str = "bucket") -> DataFrame:
    """Write rows before ``cutoff`` to a folder of this run below the archive, read
    it back, and only when the counts agree write the kept rows.  Earlier runs'
    folders stay as they are.  Returns one row of counts over the whole archive."""
    old = table.where(F.col(time) < cutoff)
    own = f"{archive_path}/run={uuid.uuid4().hex}"
    old.write.parquet(own)
    counted = spark.read.parquet(own).agg(F.count(F.lit(1)).alias("archived")).first()["archived"]
    expected = old.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    if counted != expected:
        raise RuntimeError(f"archive holds {counted} rows, expected {expected}; nothing was purged")
    table.where(F.col(time) >= cutoff).write.mode("overwrite").parquet(keep_path)
    archived = spark.read.parquet(archive_path).agg(F.count(F.lit(1)).alias("archived"), F.max(time).alias("newest_archived"))
    kept = spark.read.parquet(keep_path)
    return archived.select(
        "archived", "newest_archived",
        kept.agg(F.count(F.lit(1)).alias("n")).scalar().alias("kept"),
        kept.agg(F.min(time).alias("t")).scalar().alias("oldest_kept"),
    )


def archive_days(spark: SparkSession, path: str, archive_path: str, before: str, column: str = "day") -> DataFrame:
    """Move the day partitions older than the day ``before`` to a folder of this run
    below the archive.  Only those days are read; each is counted again from the
    archive before its folder is dropped, and younger days are not touched.  A run
    that was cut off leaves days in both places; the next one moves them again and
    the archive has them once per run.  Returns (day, archived) of this run."""
    days = [d for d in partitions(spark, path, column) if d < before]
    schema = f"{column} string, archived long"
    if not days:
        return spark.createDataFrame([], schema)
    old = spark.read.option("basePath", path).option("mergeSchema", True).parquet(*[f"{path}/{column}={d}" for d in days])
    old = old.withColumn(column, F.col(column).cast("string"))
    own = f"{archive_path}/run={uuid.uuid4().hex}"
    old.write.partitionBy(column).parquet(own)
    count = lambda df: {r[column]: r["n"] for r in df.groupBy(F.col(column).cast("string").alias(column)).agg(F.count(F.lit(1)).alias("n")).collect()}
    expected, found = count(old), count(spark.read.parquet(own))
    wrong = sorted(d for d in expected if found.get(d) != expected[d])
    if wrong:
        raise RuntimeError(f"the archive differs on {wrong}; nothing was purged")
    for d in days:
        removed(spark, f"{path}/{column}={d}")
    return spark.createDataFrame(sorted(found.items()), schema)


def retention_cutoff(newest: Column, days: int = 30) -> Column:
    return tf.plus_seconds(newest, -days * tf.DAY)
