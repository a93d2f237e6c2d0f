"""Start a query over everything available, with its own checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pulsegrid.session import work_path


def drain(stream: DataFrame, label: str, *, each=None, mode: str = "append", checkpoint: str | None = None,
          out: str | None = None, timeout: float | None = None, name: str | None = None, follow: bool = False) -> str:
    """Process all available input and stop.  Without ``each`` the rows go to a
    parquet sink (exactly once through its commit log).  Returns the output or
    checkpoint path; give the same ``checkpoint`` and ``out`` to resume.  There is
    no time limit unless the caller sets one, in seconds.

    Sources that can't say in advance where their input ends, such as a followed
    file, get one batch only from an available-now trigger, and what the watermark
    closes after it would wait for the next start.  ``follow`` runs the query as it
    would run for good and stops it when nothing is left to do."""
    spark = stream.sparkSession
    checkpoint = checkpoint or work_path(spark, f"{label}-checkpoint")
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if not follow:
        writer = writer.trigger(availableNow=True)
    if name is not None:
        writer = writer.queryName(name)
    if each is not None:
        query = writer.foreachBatch(each).start()
    else:
        out = out or work_path(spark, label)
        query = writer.format("parquet").option("path", out).start()
    if follow:
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    elif timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"{label}: input not drained within {timeout} s")
    return out or checkpoint
