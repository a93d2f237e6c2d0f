"""Tailing, closing, de-duplication, replay."""

import datetime as dt
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.functions import timeflow as tf
from pulsegrid.operators import rolling
from pulsegrid.session import work_path
from pulsegrid.sources.tail import TailReader, TailSource
from pulsegrid.streaming import alerts, samples
from pulsegrid.streaming.features import partial_sums, rolling_batch, rolling_state
from pulsegrid.streaming.run import drain


def line(item=1, clock=0, value=1.0, host="h1", name="cpu", **more):
    return json.dumps({"host": {"host": host}, "itemid": item, "name": name, "clock": clock, "ns": 0, "value": value, "type": 0, **more})


@pytest.fixture()
def export(tmp_path):
    return tmp_path


class Tail:
    """A tailing query over one folder, drained step by step."""

    def __init__(self, spark, folder, **options):
        self.spark, self.folder, self.options = spark, str(folder), options
        self.checkpoint, self.out = work_path(spark, "t-tail-c"), work_path(spark, "t-tail")
        spark.dataSource.register(TailSource)

    def lines(self):
        df = self.spark.readStream.format("tail_ndjson").options(**self.options).load(self.folder)
        drain(df, "t-tail", checkpoint=self.checkpoint, out=self.out)
        return sorted(r["line"] for r in self.spark.read.schema("line string, file string").parquet(self.out).collect())


def test_tail_follows_a_growing_file(spark, export):
    path = export / "history-a.ndjson"
    path.write_text("one\ntwo\n")
    (export / "trends-a.ndjson").write_text("other\n")
    tail = Tail(spark, export)
    assert tail.lines() == ["one", "two"]
    with open(path, "a") as f:
        f.write("three\nhal")
    assert tail.lines() == ["one", "three", "two"]
    assert tail.lines() == ["one", "three", "two"]
    with open(path, "a") as f:
        f.write("f\n")
    assert tail.lines() == ["half", "one", "three", "two"]
    path.write_text("new\n")  # rotated: shorter
    assert tail.lines() == ["half", "new", "one", "three", "two"]


def test_rotation_to_a_longer_file(export):
    path = export / "history-a.ndjson"
    path.write_text("aaa\nbbb\n")
    reader = TailReader({"path": str(export)})
    first = reader.latestOffset()
    path.write_text("ccc\nddd\neee\nfff\n")
    (part,) = reader.partitions(first, reader.latestOffset())
    assert [r[0] for r in reader.read(part)] == ["ccc", "ddd", "eee", "fff"]


def test_rotation_to_a_longer_file_of_the_same_host(export):
    path = export / "history-a.ndjson"
    host = "a-host-with-a-name-longer-than-any-fixed-number-of-leading-bytes.example.org"
    old, new = ([line(clock=c + i, host=host) for i in range(n)] for c, n in ((100, 2), (900, 5)))
    path.write_text("\n".join(old) + "\n")
    reader = TailReader({"path": str(export)})
    first = reader.latestOffset()
    path.write_text("\n".join(new) + "\n")
    (part,) = reader.partitions(first, reader.latestOffset())
    assert [r[0] for r in reader.read(part)] == new
    other = export / "fresh"
    other.write_text("\n".join(new[:1] * 9) + "\n")
    second = reader.latestOffset()
    os.replace(other, path)  # another file with the same first line
    (part,) = reader.partitions(second, reader.latestOffset())
    assert part.start == 0


def test_values_that_are_no_finite_number_and_clocks_ahead(spark):
    raw = [line(clock=60, value="NaN"), line(clock=61, value="Infinity"), line(clock=62, value=None), line(clock=1_700_000_000_000), line(clock=63, value=2.5)]
    got = samples.live_samples(samples.parse_lines(spark.createDataFrame([(r,) for r in raw], "line string")))
    assert sorted((r["clock"], r["value"]) for r in got.collect()) == [(60, 0.0), (61, 0.0), (62, 0.0), (63, 2.5)]


def test_stateful_features_outlive_empty_and_odd_values(spark, tmp_path):
    schema = "host string, key_ string, ts timestamp, value double"
    odd = [("h", "k", dt.datetime(2026, 1, 1, 0, m), v) for m, v in enumerate([1.0, None, float("nan"), 4.0, None, float("inf"), 2.0, 3.0, 5.0])]
    spark.createDataFrame(odd, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    state = rolling_state(partial_sums(stream).withWatermark("ts", "1 minute"))
    out = drain(state, "t-odd")
    got = {r["bucket"] // 60 % 60: r["value"] for r in spark.read.schema(state.schema).parquet(out).collect()}
    assert got[0] == 1.0 and 1 not in got and got[2] == 0.0 and got[3] == 4.0 and got[5] == 0.0


def test_small_splits_read_every_line_once(export):
    lines = [f"line-{i}" * (i % 7 + 1) for i in range(200)]
    (export / "history-a.ndjson").write_text("\n".join(lines) + "\n")
    for split in (1, 5, 64, 1000):
        reader = TailReader({"path": str(export), "splitBytes": str(split)})
        parts = reader.partitions({}, reader.latestOffset())
        assert [r[0] for p in parts for r in reader.read(p)] == lines


def test_parsing_defaults(spark):
    raw = [line(), "{broken", line(value="x"), json.dumps({"clock": 60})]
    parsed = samples.parse_lines(spark.createDataFrame([(x,) for x in raw], "line string"))
    assert parsed.where("is_bad").count() == 1
    got = sorted((r["host"], r["itemid"], r["value"], r["clock"]) for r in samples.live_samples(parsed).collect())
    assert got == [("", 0, 0.0, 60), ("h1", 1, 0.0, 0), ("h1", 1, 1.0, 0)]


def test_display_name_becomes_the_metric_key(spark):
    items = spark.createDataFrame([(42248, "system.cpu.util[,nice]"), (42249, "system.cpu.load[all,avg1]")], "itemid bigint, key_ string")
    rows = spark.createDataFrame([(42248, "CPU nice"), (7, "Other")], "itemid bigint, name string")
    assert {r["key_"] for r in samples.with_metric_key(rows, items).collect()} == {"system.cpu.util[,nice]", "Other"}


def deliver(spark, folder, rows):
    spark.createDataFrame(rows, "host string, key_ string, clock bigint, value double").coalesce(1).write.mode("append").parquet(folder)


def sample_rows():
    rng = np.random.default_rng(1)
    clocks = np.sort(rng.choice(np.arange(0, 200 * 60), 600, replace=False))
    return [("h1" if i % 3 else "h2", "cpu", int(c), float(round(rng.normal(10, 3), 3))) for i, c in enumerate(clocks)]


def stream(spark, folder):
    df = spark.readStream.schema("host string, key_ string, clock bigint, value double").parquet(folder)
    return df.withColumn("ts", F.timestamp_seconds("clock"))


@pytest.mark.parametrize("parts", [1, 4])
def test_batches_do_not_change_features(spark, parts):
    rows = sample_rows()
    src, root, check, check2, out2 = (work_path(spark, f"t-{n}") for n in ("src", "root", "c", "c2", "o2"))
    step = -(-len(rows) // parts)
    for i in range(0, len(rows), step):
        deliver(spark, src, rows[i:i + step])
        closed = samples.closed_means(stream(spark, src).withWatermark("ts", "1 minute")).select("host", "key_", "bucket", "value")
        drain(closed, "t", each=rolling_batch(root), checkpoint=check)
        state = rolling_state(partial_sums(stream(spark, src)).withWatermark("ts", "1 minute"))
        drain(state, "t", checkpoint=check2, out=out2)
    batch = spark.createDataFrame(rows, "host string, key_ string, clock bigint, value double")
    means = batch.groupBy("host", "key_", tf.from_epoch(F.expr("clock div 60 * 60")).alias("bucket")).agg(F.avg("value").alias("value"))
    last = (max(r[2] for r in rows) - 60) // 60 * 60
    # closed: the minute's end is at or before the watermark
    want = rolling.rolling_stats(means, ["value"], keys=("host", "key_")).where(tf.epoch_seconds(F.col("bucket")) + 60 <= last)
    cols = [c for c in want.columns if c.startswith("value_")]
    def same(a, b):
        a, b = ({(r["host"], r["bucket"]): [r[c] for c in cols] for r in df.collect()} for df in (a, b))
        assert a.keys() == b.keys() and len(a) > 200
        np.testing.assert_allclose([a[k] for k in a], [b[k] for k in a], atol=1e-9)

    same(spark.read.parquet(f"{root}/features"), want)
    with_state = spark.read.schema(rolling_state(partial_sums(stream(spark, src)).withWatermark("ts", "1 minute")).schema).parquet(out2)
    same(with_state.withColumn("bucket", tf.from_epoch(F.col("bucket"))), want)


def test_alert_sink_is_idempotent(spark):
    root = work_path(spark, "t-alerts")
    t = lambda n: tf.ntz(f"2026-08-19 10:0{n}:00")
    def feats(*minutes):
        df = spark.range(1).select(F.explode(F.array(*[t(m) for m in minutes])).alias("bucket"))
        return df.select(F.lit("h").alias("host"), "bucket")
    score = lambda df: df.select("*", F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), F.lit(s).alias("score"), F.lit(h).alias("threshold"))
        for m, s, h in (("a", 5.0, 3.0), ("b", 1.5, 0.632), ("c", 0.01, 1.0))])).alias("s")).select("host", "bucket", "s.*")
    sink = alerts.alert_sink(root, score)
    sink(feats(0, 1), 0)
    sink(feats(1, 2), 1)
    sink(feats(1, 2), 1)  # replay
    got = spark.read.parquet(root).groupBy("model").count().collect()
    assert {r["model"]: r["count"] for r in got} == {"a": 3, "b": 3}


def test_repeated_deliveries_are_dropped(spark):
    src, out, check = (work_path(spark, f"t-{n}") for n in ("dsrc", "dout", "dc"))
    for _ in range(2):
        deliver(spark, src, [("h", "cpu", c, 1.0) for c in (100, 101, 102)])
        once = samples.once_only(stream(spark, src).withColumns({"itemid": F.lit(1), "ns": F.lit(0)}))
        drain(once.select("clock"), "t", checkpoint=check, out=out)
    assert sorted(r["clock"] for r in spark.read.parquet(out).collect()) == [100, 101, 102]
