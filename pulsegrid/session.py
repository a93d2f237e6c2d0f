"""Session helpers.  Nothing here changes settings of a caller's session."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "pulsegrid") -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in
    ``spark.checkpoint.dir``.  Only where that is unset (tests, one machine)
    is a folder of our own chosen."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pulsegrid-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


_scope: ContextVar[str | None] = ContextVar("pulsegrid_scope", default=None)


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below :func:`shared_dir`."""
    scope = _scope.get()
    return f"{shared_dir(spark)}/pulsegrid/{f'{scope}/' if scope else ''}{label}-{uuid.uuid4().hex}"


@contextmanager
def working_tables(spark: SparkSession) -> Iterator[None]:
    """Removes the tables that are stored inside the block when it ends.

    Only for blocks whose results are written elsewhere, or collected, before
    they end: a DataFrame that still reads such a table fails afterwards."""
    scope = f"scope-{uuid.uuid4().hex}"
    token = _scope.set(scope)
    try:
        yield
    finally:
        _scope.reset(token)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/pulsegrid/{scope}")
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage of a table that several passes will read.

    Written as parquet to the shared folder, so that it outlives any executor
    and later passes still prune columns and push filters down."""
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle(df: DataFrame, label: str) -> DataFrame:
    """Compute a result that is expected to be small, once, and give it back
    with a size that Spark knows, so that its own threshold decides whether a
    join broadcasts it."""
    return materialize(df, label)
