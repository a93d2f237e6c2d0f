"""Bounded state, replay, renames, progress and clean-up of the live path."""

import datetime as dt
import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pulsegrid.functions import timeflow as tf
from pulsegrid.operators import bundle, rolling
from pulsegrid.plans import live, retrain
from pulsegrid.session import materialize, work_path, working_tables
from pulsegrid.sources.tail import TailSource
from pulsegrid.streaming import dimensions, progress
from pulsegrid.streaming.features import rolling_batch
from pulsegrid.streaming.run import drain
from pulsegrid.streaming.state import History, days_of, listed, put_day

T0 = dt.datetime(2026, 1, 1)
CLOSED = "host string, key_ string, bucket timestamp_ntz, value double"


def minutes(spark, a, b):
    rows = [(h, "cpu", T0 + dt.timedelta(minutes=m), float((m * 7 + len(h)) % 11)) for m in range(a, b) for h in ("h", "h2")]
    return spark.createDataFrame(rows, CLOSED)


def test_state_stays_bounded_and_results_unchanged(spark):
    """Thirty batches of ten minutes: folders and rows stay few, features are those of one batch."""
    root = work_path(spark, "t-bounded")
    run = rolling_batch(root, widths=(5, 30), keep=40)
    sizes = []
    for n in range(30):
        run(minutes(spark, 10 * n, 10 * n + 10), n)
        if n % 7 == 0:
            names = [x for x in listed(spark, f"{root}/closed") if not x.startswith(".")]
            rows = sum(spark.read.parquet(f"{root}/closed/{x}").count() for x in names)
            sizes.append((len(names), rows))
    assert max(n for n, _ in sizes) <= 10 and max(r for _, r in sizes) <= 2 * (41 + 10 * 9)
    cols = [f"value_{s}_{w}m" for w in (5, 30) for s in ("avg", "std", "trend")]
    want = rolling.rolling_stats(minutes(spark, 0, 300), ["value"], keys=("host", "key_"), widths=(5, 30))
    pick = lambda df: {(r["host"], r["bucket"]): [round(r[c], 9) for c in cols] for r in df.collect()}
    assert pick(spark.read.parquet(f"{root}/features")) == pick(want)


def test_replay_after_a_merge_reads_the_same(spark):
    h = History(work_path(spark, "t-replay"), CLOSED, 3600, every=3)
    for n in range(4):
        h.compact(spark, n)
        h.put(minutes(spark, n, n + 1), n)
    before = h.before(spark, 4).collect()
    h.compact(spark, 4)
    after = h.before(spark, 4).collect()
    h.compact(spark, 4)  # the failed batch again
    assert sorted(before) == sorted(after) == sorted(h.before(spark, 4).collect()) and len(before) == 8
    # a merge that was cut off leaves a folder without its mark; it is not read
    os.makedirs(f"{h.root.removeprefix('file:')}/base-9")
    assert len(h.before(spark, 20).collect()) == 8


def test_only_the_days_of_a_batch_are_read(spark):
    root = work_path(spark, "t-days")
    rows = minutes(spark, 0, 5)
    put_day(rows, root, 0)
    put_day(rows.withColumn("bucket", tf.plus_seconds(F.col("bucket"), 3 * tf.DAY)), root, 1)
    got = days_of(spark, root, rows, CLOSED)
    assert got.count() == 10 and {Path(f).parent.parent.name for f in got.inputFiles()} == {"day=2026-01-01"}
    put_day(rows.limit(2), root, 0)  # a replay replaces
    assert days_of(spark, root, rows, CLOSED).count() == 2
    assert days_of(spark, root + "/none", rows, CLOSED).count() == 0


def test_renames_are_valid_from_their_time(spark):
    path = work_path(spark, "t-items")
    snapshot = lambda *rows: spark.createDataFrame(list(rows), "itemid bigint, key_ string")
    dimensions.publish(snapshot((1, "a"), (2, "b")), path, tf.ntz("2026-01-01 00:00:00"))
    dimensions.publish(snapshot((1, "a2"), (2, "b"), (3, "c")), path, tf.ntz("2026-01-02 00:00:00"))
    dimensions.publish(snapshot((1, "a"), (2, "b"), (3, "c")), path, tf.ntz("2026-01-03 00:00:00"))
    known = dimensions.versions(spark, path)
    assert known.count() == 5  # only what changed
    times = [dt.datetime(2025, 12, 1), dt.datetime(2026, 1, 1, 23, 59), dt.datetime(2026, 1, 2), dt.datetime(2026, 1, 5)]
    rows = spark.createDataFrame([(i, t, "shown") for i in (1, 2, 3, 9) for t in times], "itemid bigint, bucket timestamp_ntz, name string")
    got = {(r["itemid"], r["bucket"].day, r["bucket"].month): r["key_"] for r in dimensions.keyed(rows, known).collect()}
    assert [got[1, *d] for d in ((1, 12), (1, 1), (2, 1), (5, 1))] == ["a", "a", "a2", "a"]
    assert got[3, 1, 12] == "c" and got[9, 5, 1] == "shown" and got[2, 5, 1] == "b"


def test_backlog_of_offsets():
    assert progress.backlog('{"f": [10, 1, "x"]}', '{"f": [25, 1, "x"], "g": [5, 2, "y"]}') == 20
    assert progress.backlog('{"logOffset": 3}', '{"logOffset": 7}') == 4
    assert progress.backlog(None, '{"f": 4}') == 4
    assert progress.backlog("-", "7") is None and progress.backlog("{}", None) is None and progress.backlog('{"a": "x"}', '{"a": "y"}') is None


def test_working_tables_are_removed(spark):
    with working_tables(spark):
        inside = materialize(spark.range(5), "t-inside")
        folder = Path(inside.inputFiles()[0].removeprefix("file:")).parent.parent
        assert inside.count() == 5 and folder.exists()
    assert not folder.exists()
    outside = materialize(spark.range(5), "t-outside")
    assert outside.count() == 5


def line(host, name, minute, value):
    return json.dumps({"host": {"host": host}, "itemid": 1 + (name != "cpu"), "name": name, "clock": int((T0 + dt.timedelta(minutes=minute)).replace(
        tzinfo=dt.timezone.utc).timestamp()), "ns": minute, "value": value})


def test_a_promoted_run_is_picked_up_between_batches(spark, tmp_path):
    """Without an active run nothing is scored; after each promotion the next batch uses that run; a replayed
    batch leaves the scores as they are; the metric of a renamed item goes on under its new name."""
    spark.dataSource.register(TailSource)
    keys = ["cpu", "mem"]
    wave = lambda m: [("h", "cpu", m, 10.0 + (m * 7) % 5), ("h", "mem", m, 50.0 + (m * 3) % 4)]
    rows = [(h, n, T0 + dt.timedelta(minutes=m), v) for k in range(400) for h, n, m, v in wave(k)]
    long = spark.createDataFrame(rows, "host string, key_ string, bucket timestamp_ntz, value double")
    wide = long.groupBy("host", "bucket").pivot("key_", keys).agg(F.avg("value"))
    none = spark.createDataFrame([], "host string, start_ts timestamp_ntz, end_ts timestamp_ntz, label string, seq_no int")
    models, items = work_path(spark, "t-models"), work_path(spark, "t-items")
    s = retrain.Settings(top_k=4, min_test_rows=10, trees=10, seq_len=10, widths=(5,), seq_by="grid", block=300)
    for run_id in ("a", "b"):
        retrain.run(wide, keys, none, tf.ntz("2026-01-01 05:00:00"), s, root=models, run_id=run_id)
    dimensions.publish(spark.createDataFrame([(1, "cpu"), (2, "mem")], "itemid bigint, key_ string"), items, tf.ntz("2026-01-01 00:00:00"))
    at = live.Live(work_path(spark, "t-live"), models, items, keys, keep=30, every=2)
    check, path, seen = work_path(spark, "t-live-c"), tmp_path / "history-a.ndjson", {}
    each = live.scorer(at)

    def remembered(batch, batch_id):
        seen[batch_id] = batch.collect()
        each(batch, batch_id)

    for step, run_id in enumerate((None, "a", "b")):
        if run_id:
            bundle.promote(spark.createDataFrame([(run_id,)], "run_id string"), models)
        with open(path, "a") as f:
            for m in range(40 * step, 40 * step + 40):
                f.writelines(line(*r) + "\n" for r in wave(m))
                f.write("{broken\n")
        lines = spark.readStream.format("tail_ndjson").load(str(tmp_path))
        sums = live.bucket_sums(lines)
        drain(sums, "t-live", each=remembered, checkpoint=check, follow=True)
    scores = spark.read.parquet(at.scores)
    by = {r["run_id"]: r for r in scores.groupBy("run_id").agg(F.count_distinct("bucket").alias("n"), F.min("bucket").alias("first")).collect()}
    assert set(by) == {"a", "b"} and by["b"]["first"] >= T0 + dt.timedelta(minutes=78)
    votes = live.votes(scores)
    assert votes.count() == scores.select("host", "bucket").distinct().count() and votes.agg(F.max("n_models")).first()[0] == 3
    pick = lambda: sorted((r["model"], r["bucket"], round(r["score"], 9)) for r in spark.read.parquet(at.scores).collect())
    want = pick()
    last = max(b for b, r in seen.items() if r)
    each(spark.createDataFrame(seen[last], sums.schema), last)
    assert pick() == want


def test_history_shorter_than_a_bundle_is_refused(spark):
    with pytest.raises(ValueError, match="further"):
        rolling_batch("x", widths=(5, 60), keep=30)
