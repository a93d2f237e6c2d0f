"""Time-based rolling statistics, sequences, grids and gaps.

Each key's time line is cut into blocks of buckets.  A row is copied into the
following block only when that block's windows look back to it, so results are
exact while no task ever holds more than block + width rows of one key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions import timeflow as tf
from pulsegrid.functions.metrics import ROLLING_WIDTHS, named, quoted


def _with_lookback(df: DataFrame, pos: Column, reach: int, block: int) -> DataFrame:
    """Copies rows into every block whose windows reach back to them."""
    home = tf.int_div(F.col("_pos"), block)
    until = tf.int_div(F.col("_pos") + F.lit(reach), block)
    return (
        df.withColumn("_pos", pos)
        .withColumn("_block", F.explode(F.sequence(home, until)))
        .withColumn("_home", F.col("_block") == home)
    )


def rolling_stats(
    df: DataFrame,
    columns: Sequence[str],
    *,
    keys: Sequence[str] = ("host",),
    time: str = "bucket",
    width: int = tf.MINUTE,
    widths: Sequence[int] = ROLLING_WIDTHS,
    stats: Sequence[str] = ("avg", "std", "trend"),
    block: int = 1440,
    name=lambda column, stat, w: f"{column}_{stat}_{w}m",
) -> DataFrame:
    """avg, population std and trend over the last w buckets, per column.

    Works on the wide matrix (keys = host) and on the long table
    (keys = host, key_; column = value).  All statistics of all widths share
    one shuffle and one sort.
    """
    partition = ", ".join([*map(quoted, keys), "_block"])
    out: dict[str, Column] = {}
    for c in columns:
        x = quoted(c)
        for w in widths:
            over = f"OVER (PARTITION BY {partition} ORDER BY _pos RANGE BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
            rise = f"(last({x}, true) {over} - first({x}, true) {over}) / count({x}) {over}"
            forms = {
                "avg": f"avg({x}) {over}",
                "std": f"coalesce(stddev_pop({x}) {over}, 0D)",
                "trend": f"CASE WHEN count({x}) {over} >= 2 THEN {rise} ELSE 0D END",
            }
            out |= {name(c, stat, w): F.expr(forms[stat]) for stat in stats}
    placed = _with_lookback(df, tf.bucket_index(F.col(time), width), max(widths) - 1, block)
    return placed.withColumns(out).where("_home").drop("_pos", "_block", "_home")


def rolling_long(df: DataFrame, columns: Sequence[str], *, keys: Sequence[str] = ("host",), time: str = "bucket", **kw) -> DataFrame:
    """The same statistics as rows (keys, time, key_, value, value_<stat>_<w>m).

    For matrices of hundreds of metrics: every (host, metric, block) is its own
    small window task, and the plan holds nine expressions instead of nine per
    metric.  Pivot only the features a model selected."""
    cells = F.array(*[F.struct(F.lit(c).alias("key_"), named(c).cast("double").alias("value")) for c in columns])
    long = df.select(*keys, time, F.explode(cells).alias("_c")).select(*keys, time, "_c.*")
    return rolling_stats(long, ["value"], keys=[*keys, "key_"], time=time, **kw)


def rolling_with_history(test: DataFrame, history: DataFrame, columns: Sequence[str], **kw) -> DataFrame:
    """Rolling features of ``test`` rows that also see earlier rows of
    ``history``; only test rows come back.  Frames look backward only, so no
    history row can be influenced by a test row."""
    both = history.withColumn("_is_test", F.lit(False)).unionByName(
        test.withColumn("_is_test", F.lit(True)), allowMissingColumns=True
    )
    return rolling_stats(both, columns, **kw).where("_is_test").drop("_is_test")


def bucket_grid(df: DataFrame, *, host: str = "host", time: str = "bucket", width: int = tf.MINUTE,
                block: int = 1440) -> DataFrame:
    """Continuous grid from first to last bucket per host.  Blocks are exploded
    before buckets, so that a long history spreads over tasks."""
    pos = tf.bucket_index(F.col(time), width)
    ends = df.groupBy(host).agg(F.min(pos).alias("lo"), F.max(pos).alias("hi"))
    blocks = ends.withColumn(
        "b", F.explode(F.sequence(tf.int_div(F.col("lo"), block), tf.int_div(F.col("hi"), block)))
    ).repartition(host, "b")
    first = F.greatest(F.col("lo"), F.col("b") * F.lit(block))
    last = F.least(F.col("hi"), (F.col("b") + F.lit(1)) * F.lit(block) - F.lit(1))
    return blocks.withColumn("p", F.explode(F.sequence(first, last))).select(
        host, tf.from_epoch(F.col("p") * F.lit(width)).alias(time)
    )


def gaps(df: DataFrame, *, keys: Sequence[str] = ("host",), time: str = "bucket",
         over_minutes: float = 70, block: int = tf.DAY) -> DataFrame:
    """Pairs of consecutive distinct times more than ``over_minutes`` apart.

    Pairs inside a day come from a window per (key, day); pairs across days
    from the first and last time of each day, one row per key and day.
    """
    day = tf.bucket_index(F.col(time), block)
    times = df.select(*keys, time).distinct().withColumn("_day", day)
    within = times.select(
        *keys, F.lag(time).over(Window.partitionBy(*keys, "_day").orderBy(time)).alias("gap_from"),
        F.col(time).alias("gap_to"),
    )
    edge = times.groupBy(*keys, "_day").agg(F.min(time).alias("lo"), F.max(time).alias("hi"))
    across = edge.select(
        *keys, F.lag("hi").over(Window.partitionBy(*keys).orderBy("_day")).alias("gap_from"),
        F.col("lo").alias("gap_to"),
    )
    minutes = tf.seconds_between(F.col("gap_to"), F.col("gap_from")) / 60.0
    return (
        within.unionByName(across)
        .where(F.col("gap_from").isNotNull() & (minutes > over_minutes))
        .withColumn("minutes", F.round(minutes, 1))
    )


def number_rows(df: DataFrame, *, keys: Sequence[str] = ("host",), time: str = "bucket",
                width: int = tf.MINUTE, block: int = 1440, out: str = "row_no") -> DataFrame:
    """0-based row number per key in time order, without a window over a whole
    key: blocks are numbered inside, then shifted by the rows of earlier blocks."""
    placed = df.withColumn("_b", tf.int_div(tf.bucket_index(F.col(time), width), block))
    counts = placed.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(*keys, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    inside = F.row_number().over(Window.partitionBy(*keys, "_b").orderBy(time))
    return (
        placed.withColumn("_r", inside)
        .join(shift, [*keys, "_b"])
        .withColumn(out, F.col("_shift") + F.col("_r") - F.lit(1))
        .drop("_b", "_r", "_shift")
    )


def sequences(df: DataFrame, columns: Sequence[str], *, length: int = 60,
              keys: Sequence[str] = ("host",), time: str = "bucket", width: int = tf.MINUTE,
              block: int = 1440, by: str = "rows", out: str = "sequence") -> DataFrame:
    """The last ``length`` rows (``by='rows'``), the rows of the last ``length``
    buckets (``by='time'``), or these buckets with zeros where there is no row
    (``by='grid'``) of each row, as an array of vectors.

    Rows without a full sequence are left out in the row form.  The grid form
    needs nothing but the last buckets, so a stream with bounded history gives
    what a batch gives; zeros are means when columns are scaled.  Sequences never
    cross a host.  Give only the few columns a model needs: data grows by
    ``length``."""
    vector = F.array(*[named(c).cast("double") for c in columns])
    base = df.withColumn("_vec", vector)
    if by == "rows":
        numbered = number_rows(base, keys=keys, time=time, width=width, block=block, out="_row")
        placed = _with_lookback(numbered, F.col("_row"), length - 1, block)
        frame = Window.partitionBy(*keys, "_block").orderBy("_pos").rowsBetween(-(length - 1), 0)
    elif by in ("time", "grid"):
        placed = _with_lookback(base, tf.bucket_index(F.col(time), width), length - 1, block)
        frame = Window.partitionBy(*keys, "_block").orderBy("_pos").rangeBetween(-(length - 1), 0)
    else:
        raise ValueError(f"unknown sequence rule: {by}")
    if by == "grid":
        cells = F.map_from_entries(F.collect_list(F.struct("_pos", "_vec")).over(frame))
        zeros = F.array(*[F.lit(0.0) for _ in columns])
        done = placed.withColumn("_cells", cells).where("_home").withColumn(out, F.transform(
            F.sequence(F.col("_pos") - F.lit(length - 1), F.col("_pos")), lambda p: F.coalesce(F.try_element_at("_cells", p), zeros))).drop("_cells")
    else:
        done = placed.withColumn(out, F.collect_list("_vec").over(frame)).where("_home")
    if by == "rows":
        done = done.where(F.size(out) == length)
    return done.drop("_vec", "_row", "_pos", "_block", "_home")
