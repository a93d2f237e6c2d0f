"""Rolling features on the stream, by the same code as in batch.

Each micro-batch of closed buckets is stored, then its rolling features are
computed over itself plus the stored buckets of the last ``max(widths)``.
Replaying a failed batch changes nothing, and what is kept does not grow with
the uptime (:mod:`pulsegrid.streaming.state`).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pulsegrid.functions import timeflow as tf
from pulsegrid.functions.metrics import ROLLING_WIDTHS
from pulsegrid.operators.rolling import rolling_with_history
from pulsegrid.streaming.samples import KEEP_MINUTES
from pulsegrid.streaming.state import History, days_of, put_day


def rolling_batch(root: str, *, keys: Sequence[str] = ("host", "key_"), column: str = "value",
                  time: str = "bucket", width: int = tf.MINUTE, widths: Sequence[int] = ROLLING_WIDTHS,
                  keep: int = KEEP_MINUTES, then: Callable[[DataFrame, int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: closed buckets in, features in ``root/features``
    by day; ``then`` receives the features of the batch.

    ``root/closed`` holds the last ``keep`` buckets and never more than a few
    folders."""
    if keep < max(widths):
        raise ValueError("windows look back further than buckets are kept")

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batch.schema.fields)
        closed = History(f"{root}/closed", fields, keep * width, time)
        closed.compact(spark, batch_id)
        mine = closed.put(batch, batch_id)
        first = mine.agg(F.min(time).alias("t")).first()["t"]
        if first is None:
            return
        reach = tf.plus_seconds(F.lit(first).cast("timestamp_ntz"), -(max(widths) - 1) * width)
        history = closed.before(spark, batch_id).where(F.col(time) >= reach)
        rolled = rolling_with_history(mine, history, [column], keys=keys, time=time, width=width, widths=widths)
        put_day(rolled, f"{root}/features", batch_id, time)
        if then is not None:
            schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rolled.schema.fields)
            stored = days_of(spark, f"{root}/features", mine, schema, time)
            then(stored.where(F.col("batch_id") == batch_id).select(*rolled.columns), batch_id)

    return run


def partial_sums(samples: DataFrame, width: int = tf.MINUTE, time: str = "ts") -> DataFrame:
    """Map-side combine of a micro-batch: each task ships one row per (host,
    key, bucket), so one hot series does not ship its raw samples."""
    finite = F.when(F.isnan("value") | (F.abs("value") == float("inf")), F.lit(0.0)).otherwise(F.col("value"))
    flat = samples.select("host", "key_", F.col(time).alias("ts"), F.unix_micros(F.col(time)).alias("us"), finite.alias("value"))

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["bucket"] = pdf["us"] // (width * 1_000_000) * width
            out = pdf.groupby(["host", "key_", "bucket"], as_index=False).agg(
                ts=("ts", "max"), total=("value", "sum"), n=("value", "count")
            )
            yield out[["host", "key_", "bucket", "ts", "total", "n"]]

    return flat.mapInPandas(combine, "host string, key_ string, bucket long, ts timestamp, total double, n long")


def rolling_state(sums: DataFrame, *, width: int = tf.MINUTE, widths: Sequence[int] = ROLLING_WIDTHS,
                  keep: int = KEEP_MINUTES) -> DataFrame:
    """The low-latency variant: per (host, key) a bounded series of bucket
    means lives in streaming state, and a bucket's features are emitted as soon
    as the watermark passes it.  ``sums`` comes from :func:`partial_sums` with
    a watermark on ``ts``."""
    widths = tuple(widths)
    names = [f"value_{stat}_{w}m" for w in widths for stat in ("avg", "std", "trend")]
    schema = "host string, key_ string, bucket long, value double, " + ", ".join(f"`{n}` double" for n in names)

    def features(times: np.ndarray, values: np.ndarray, now: int) -> list[float]:
        row: list[float] = []
        for w in widths:
            x = values[(times > now - w * width) & (times <= now)]
            row += [x.mean(), x.std() if len(x) > 1 else 0.0, (x[-1] - x[0]) / len(x) if len(x) > 1 else 0.0]
        return row

    def update(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        times, totals, counts, done = state.get if state.exists else ([], [], [], -1)
        series = {t: [s, n] for t, s, n in zip(times, totals, counts)}
        for pdf in batches:
            for t, s, n in zip(pdf["bucket"], pdf["total"], pdf["n"]):
                if t > done and n:  # nothing to average in a bucket of empty values
                    slot = series.setdefault(int(t), [0.0, 0])
                    slot[0] += float(s)
                    slot[1] += int(n)
        mark = state.getCurrentWatermarkMs() // 1000
        ordered = sorted(series)
        at = np.array(ordered, dtype="int64")
        mean = np.array([series[t][0] / series[t][1] for t in ordered])
        rows = [
            [key[0], key[1], t, m, *features(at, mean, t)]
            for t, m in zip(ordered, mean) if done < t and t + width <= mark
        ]
        if rows:
            done = rows[-1][2]
            yield pd.DataFrame(rows, columns=["host", "key_", "bucket", "value", *names])
        floor = max(done, mark) - keep * width
        alive = [t for t in ordered if t >= floor or t > done]
        waiting = [t for t in alive if t > done]
        if alive:
            state.update((alive, [series[t][0] for t in alive], [series[t][1] for t in alive], done))
            wake = (min(waiting) + width) if waiting else (max(alive) + keep * width)
            state.setTimeoutTimestamp(max(wake, mark + 1) * 1000)
        elif state.exists:
            state.remove()

    return sums.groupBy("host", "key_").applyInPandasWithState(
        update, schema, "times array<long>, totals array<double>, counts array<long>, done long",
        "append", GroupStateTimeout.EventTimeTimeout,
    )
