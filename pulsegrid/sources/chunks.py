"""Raw chunks as parquet partitions: write, read back, validate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.operators.matrix import keep_last
from pulsegrid.operators.warehouse import read_table, remember_schema, table_exists

# Which tables a chunk must have, may have, and which snapshots
# must exist.
REQUIRED = ("history",)
OPTIONAL = ("trends", "events", "problem")
SNAPSHOTS = ("hosts", "items", "triggers", "functions")


def write_chunks(df: DataFrame, path: str, chunk: str = "chunk_id") -> None:
    """Each chunk is one partition; writing a chunk again replaces it, an empty
    chunk writes nothing.

    Rows are rebalanced by chunk: small chunks share a task, and a chunk that
    holds a large part of the data is split over as many tasks as its size
    asks for."""
    (
        df.hint("rebalance", chunk).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy").partitionBy(chunk).parquet(path)
    )
    if table_exists(df.sparkSession, path):
        remember_schema(df.sparkSession, path, df.schema)


def has_chunks(spark: SparkSession, path: str) -> bool:
    """A table of which every chunk was empty has a folder but no chunk."""
    return table_exists(spark, f"{path}/chunk_id=*")


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """All chunks; an unreadable file is an error, since a chunk that is half
    read would be marked as loaded."""
    return read_table(spark, path)


def ingest(read_range, read_dim, root: str, chunk_id: str) -> bool:
    """One hour: four fact tables and four snapshots.  ``read_range(table)``
    and ``read_dim(table)`` give DataFrames.  False when no fact has rows."""
    any_rows = False
    for table in (*REQUIRED, *OPTIONAL):
        df = read_range(table).withColumn("chunk_id", F.lit(chunk_id))
        write_chunks(df, f"{root}/{table}")
        spark = df.sparkSession
        if table_exists(spark, f"{root}/{table}/chunk_id={chunk_id}"):
            any_rows = True
    for table in SNAPSHOTS:
        read_dim(table).write.mode("overwrite").parquet(f"{root}/{table}/latest")
    return any_rows


def load_raw(spark: SparkSession, path: str, key: Sequence[str], order: Sequence[str] = ("chunk_id",)) -> DataFrame:
    """All chunks of one raw table, last chunk wins per primary key."""
    return keep_last(read_chunks(spark, path), key, order)


def validate(counts: DataFrame, expected: DataFrame, chunk: str = "chunk_id", table: str = "table_name") -> DataFrame:
    """``expected``: (chunk, table, required).  ``counts``: (chunk, table, n).
    A required table without rows is an error, an optional one a warning."""
    n = F.coalesce(F.col("n"), F.lit(0))
    status = (
        F.when(n > 0, "ok").when(F.col("required"), "error").otherwise("warning")
    )
    return expected.join(counts, [chunk, table], "left").select(
        chunk, table, "required", n.alias("n_rows"), status.alias("status")
    )


def validate_files(spark: SparkSession, root: str, chunk_id: str) -> DataFrame:
    """The same rule on a chunk's files.  Row counts come from parquet footers;
    only file existence is looked up by the driver."""
    rows = []
    for table in (*REQUIRED, *OPTIONAL):
        path = f"{root}/{table}/chunk_id={chunk_id}"
        n = spark.read.parquet(path).count() if table_exists(spark, path) else 0
        status = "ok" if n else ("error" if table in REQUIRED else "warning")
        rows.append((chunk_id, table, table in REQUIRED, n, status))
    for table in SNAPSHOTS:
        found = table_exists(spark, f"{root}/{table}/latest")
        rows.append((chunk_id, table, True, None, "ok" if found else "error"))
    return spark.createDataFrame(rows, "chunk_id string, table_name string, required boolean, n_rows long, status string")
