"""Streaming queries: the stream reads the events table, drains it and the
closed part is compared with batch SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pulsegrid.functions import timeflow as tf
from pulsegrid.operators import bundle, evaluate
from pulsegrid.plans import live as plan
from pulsegrid.plans import retrain
from pulsegrid.session import materialize, work_path
from pulsegrid.sources.tail import TailSource
from pulsegrid.streaming import alerts as al
from pulsegrid.streaming import dimensions, progress
from pulsegrid.streaming import features as sf_features
from pulsegrid.streaming import samples as live
from pulsegrid.streaming.run import drain
from pulsegrid.suite import roles
from pulsegrid.suite.registry import query
from pulsegrid.suite.roles import PRED, S, SPLIT, WIDE, WIDTH, WIDTHS, rounded, table

DELAY = "1 hour"


def event_stream(spark, sf):
    """The events table as a stream with event time."""
    schema = table(spark, sf, "events").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return raw.select(
        "event_id", roles.host_of_user().alias("host"), F.col("event_type").alias("key_"),
        tf.as_instant(F.col("ts")).alias("ts"), "value", "props", "user_id",
    )


def lines_of(df):
    """Samples as exported lines."""
    return df.select(F.to_json(F.struct(
        F.struct("host").alias("host"), F.col("event_id").alias("itemid"), F.col("key_").alias("name"),
        tf.epoch_seconds(F.col("ts")).alias("clock"), F.lit(0).alias("ns"), "value",
    )).alias("value"))


LAST = "(SELECT max(ts) - INTERVAL 1 HOUR FROM s)"


@query("stream_minute_avg", f"""WITH {S} SELECT host, key_, bucket, round(avg(value) + 3e-8, 6) AS value, count(*) AS n FROM s
GROUP BY 1, 2, 3 HAVING bucket + INTERVAL 1 HOUR <= {LAST}""")
def stream_minute_avg(spark, sf):
    stream = event_stream(spark, sf).withWatermark("ts", DELAY)
    means = live.closed_means(stream, width="1 hour")
    return rounded(spark.read.schema(means.schema).parquet(drain(means, "closed")), "value")


@query("stream_sliding_avg", f"""WITH {S}, g AS (SELECT host, key_, bucket + unnest([1, 2, 3, 4, 5]) * INTERVAL 1 HOUR AS window_end, value FROM s)
SELECT host, key_, window_end, round(avg(value) + 3e-8, 6) AS value, count(*) AS n FROM g GROUP BY 1, 2, 3 HAVING window_end <= {LAST}""")
def stream_sliding_avg(spark, sf):
    stream = event_stream(spark, sf).withWatermark("ts", DELAY)
    means = live.sliding_means(stream, width="5 hours", step="1 hour")
    return rounded(spark.read.schema(means.schema).parquet(drain(means, "sliding")), "value")


@query("stream_dedup", f"WITH {S} SELECT event_id, host, key_, value FROM s")
def stream_dedup(spark, sf):
    # every sample delivered twice
    twice = event_stream(spark, sf).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    once = live.once_only(twice, keys=("event_id",), delay=DELAY).select("event_id", "host", "key_", "value")
    return spark.read.schema(once.schema).parquet(drain(once, "dedup"))


@query("stream_static_lookup", """SELECT e.event_id, e.user_id AS itemid, coalesce(p.p_name, e.event_type) AS key_
FROM events e LEFT JOIN (SELECT p_partkey, p_name FROM part WHERE p_size < 25) p ON p.p_partkey = e.user_id""")
def stream_static_lookup(spark, sf):
    items = table(spark, sf, "part").where("p_size < 25").select(F.col("p_partkey").alias("itemid"), F.col("p_name").alias("key_"))
    stream = event_stream(spark, sf).select("event_id", F.col("user_id").alias("itemid"), F.col("key_").alias("name"))
    named = live.with_metric_key(stream, items).select("event_id", "itemid", "key_")
    return spark.read.schema(named.schema).parquet(drain(named, "lookup"))


@query("stream_bad_lines", "SELECT count(*) FILTER (value > 100) AS bad_lines, count(*) FILTER (value <= 100) AS good_lines, round(sum(value) FILTER (value <= 100) + 3e-6, 4) AS total FROM events")
def stream_bad_lines(spark, sf):
    # large samples arrive as lines that are cut off
    stream = event_stream(spark, sf)
    text = F.to_json(F.struct(F.struct("host").alias("host"), F.col("event_id").alias("itemid"), "value"))
    lines = stream.select(F.when(F.col("value") > 100, F.regexp_replace(text, "}$", "")).otherwise(text).alias("line"))
    parsed = live.parse_lines(lines).select("is_bad", F.col("_doc.value").try_cast("double").alias("value"))
    got = spark.read.schema(parsed.schema).parquet(drain(live.observed(parsed), "lines"))
    return rounded(got.agg(
        F.count_if("is_bad").alias("bad_lines"), F.count_if(~F.col("is_bad")).alias("good_lines"),
        F.sum(F.when(~F.col("is_bad"), F.col("value"))).alias("total"),
    ), "total", digits=4)


@query("stream_tail_ndjson", f"WITH {S} SELECT host, key_, count(*) AS n, round(sum(value) + 3e-6, 4) AS total, min(floor(epoch(ts))::BIGINT) AS first_clock FROM s GROUP BY 1, 2")
def stream_tail_ndjson(spark, sf):
    spark.dataSource.register(TailSource)
    folder = work_path(spark, "export")
    lines_of(roles.samples(spark, sf)).write.text(folder)
    local = folder.removeprefix("file:")
    lines = spark.readStream.format("tail_ndjson").option("pattern", "part-*").option("splitBytes", 1 << 20).load(local)
    typed = live.live_samples(live.parse_lines(lines)).select("host", F.col("name").alias("key_"), "clock", "value")
    got = spark.read.schema(typed.schema).parquet(drain(typed, "tail"))
    return rounded(got.groupBy("host", "key_").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.min("clock").alias("first_clock")
    ), "total", digits=4)


def closed_means(spark, sf):
    stream = event_stream(spark, sf).withWatermark("ts", DELAY)
    return live.closed_means(stream, width="1 hour").select("host", "key_", "bucket", "value")


VALUE_COLS = [f"value_{st}_{w}m" for w in WIDTHS for st in ("avg", "std", "trend")]
SQL_LONG = f"""WITH {S}, ml AS (SELECT host, key_, bucket, avg(value) AS value FROM s GROUP BY 1, 2, 3),
 rl AS (SELECT host, key_, bucket, {", ".join(f"{roles.sql_stat('value', st, w)} AS value_{st}_{w}m" for w in WIDTHS for st in ("avg", "std", "trend"))} FROM ml)
SELECT host, key_, bucket, {", ".join(f"round({c} + 3e-8, 6) AS {c}" for c in VALUE_COLS)}
FROM rl WHERE bucket + INTERVAL 1 HOUR <= {LAST}""".replace("PARTITION BY host", "PARTITION BY host, key_")


@query("stream_rolling", SQL_LONG)
def stream_rolling(spark, sf):
    root = work_path(spark, "rolling")
    each = sf_features.rolling_batch(root, width=WIDTH, widths=WIDTHS)
    drain(closed_means(spark, sf), "rolling", each=each)
    got = spark.read.parquet(f"{root}/features").select("host", "key_", "bucket", *VALUE_COLS)
    return rounded(got, *VALUE_COLS)


@query("stream_rolling_state", SQL_LONG)
def stream_rolling_state(spark, sf):
    sums = sf_features.partial_sums(event_stream(spark, sf), WIDTH).withWatermark("ts", DELAY)
    rows = sf_features.rolling_state(sums, width=WIDTH, widths=WIDTHS)
    got = spark.read.schema(rows.schema).parquet(drain(rows, "rolling-state"))
    return rounded(got.select("host", "key_", tf.from_epoch(F.col("bucket")).alias("bucket"), *VALUE_COLS), *VALUE_COLS)


@query("stream_alerts", f"""{PRED} SELECT model, host, bucket, round(score + 3e-8, 6) AS score, round(threshold + 3e-8, 6) AS threshold FROM p
WHERE y_pred = 1 AND bucket + INTERVAL 1 HOUR <= {LAST}""")
def stream_alerts(spark, sf):
    train = materialize(roles.scores(spark, sf), "scores").where(F.col("bucket") < roles.split())
    limits = evaluate.thresholds(train, [0.99])
    root = work_path(spark, "live")

    def score(rows):
        test = rows.where(F.col("bucket") >= roles.split())
        scored = evaluate.rolling_zscore(test, "value", WIDTHS, ids=("host", "key_", "bucket"))
        model = F.when(F.col("key_") == roles.KEYS[0], F.col("model")).otherwise(F.concat_ws("_", "key_", "model"))
        return scored.withColumn("model", model).join(limits.select("model", "threshold"), "model")

    each = sf_features.rolling_batch(root, width=WIDTH, widths=WIDTHS, then=al.alert_sink(f"{root}/alerts", score))
    drain(closed_means(spark, sf), "alerts", each=each)
    return rounded(spark.read.parquet(f"{root}/alerts").select("model", "host", "bucket", "score", "threshold"), "score", "threshold")


def delivered(spark, df, folder):
    """Lines of ``df`` as one more export file of a folder."""
    lines_of(df).coalesce(1).write.mode("append").text(folder)


@query("live_models", f"""{WIDE}, k AS (SELECT host, bucket FROM m WHERE bucket >= TIMESTAMP '{SPLIT}' AND bucket + INTERVAL 1 HOUR <= {LAST})
SELECT model, count(*) AS n_rows, count(*) AS n_equal, true AS same_alerts FROM k, (SELECT unnest(['isolation_forest', 'one_class', 'sequence']) AS model)
GROUP BY model""")
def live_models(spark, sf):
    """Tail to alert with the stored models: three deliveries, and then the stream's
    scores and alerts next to those of the same bundle over the whole table."""
    spark.dataSource.register(TailSource)
    models, folder = work_path(spark, "models"), work_path(spark, "export")
    wide = roles.wide(spark, sf).select("host", "bucket", *roles.KEYS)
    s = retrain.Settings(width=WIDTH, widths=WIDTHS, block=roles.BLOCK, min_test_rows=1, top_k=20, trees=50, seq_by="grid")
    made = retrain.run(wide, roles.KEYS, roles.windows(spark, sf), roles.split(), s, root=models, run_id="r1")
    bundle.promote(spark.createDataFrame([("r1",)], "run_id string"), models)
    items = work_path(spark, "items")
    at = plan.Live(work_path(spark, "live"), models, items, roles.KEYS, width=WIDTH, every=2)
    cuts = [tf.ntz(f"2024-01-{d} 00:00:00") for d in ("16", "24")]
    ts, samples = F.col("ts"), roles.samples(spark, sf)
    check = work_path(spark, "live-checkpoint")
    for part in (ts < cuts[0], (ts >= cuts[0]) & (ts < cuts[1]), ts >= cuts[1]):
        delivered(spark, samples.where(part), folder)
        lines = spark.readStream.format("tail_ndjson").option("pattern", "part-*").load(folder.removeprefix("file:"))
        drain(plan.bucket_sums(lines, width="1 hour", delay=DELAY), "live", each=plan.scorer(at), checkpoint=check, follow=True)
    got = spark.read.parquet(at.scores).where(F.col("bucket") >= roles.split())
    batch = made["predictions"].select("model", "host", "bucket", F.col("score").alias("batch"), F.col("y_pred").alias("flag"))
    both = got.join(batch, ["model", "host", "bucket"], "left")
    alerts = spark.read.parquet(at.alerts).select("model", "host", "bucket", F.lit(1).alias("alerted"))
    both = both.join(alerts, ["model", "host", "bucket"], "left").fillna(0, ["alerted"])
    return both.groupBy("model").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.abs(F.col("score") - F.col("batch")) < 1e-6).alias("n_equal"),
        F.bool_and(F.col("alerted") == F.col("flag")).alias("same_alerts"))


RENAMED = "2024-01-16 00:00:00"


@query("live_renamed_items", f"""WITH b AS (SELECT 'h' || (user_id % 5)::VARCHAR AS host, user_id, event_type, date_trunc('hour', ts) AS bucket, value FROM events),
 k AS (SELECT b.*, CASE WHEN p.p_partkey IS NULL THEN event_type WHEN bucket >= TIMESTAMP '{RENAMED}' AND user_id % 2 = 0 THEN p_name || ' (new)' ELSE p_name END AS key_
  FROM b LEFT JOIN (SELECT p_partkey, p_name FROM part WHERE p_size < 25) p ON p.p_partkey = b.user_id)
SELECT host, key_, bucket, round(avg(value) + 3e-8, 6) AS value, count(*) AS n FROM k
WHERE bucket + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY 1, 2, 3""")
def live_renamed_items(spark, sf):
    """Half of the items are renamed between two deliveries of a stream: every bucket
    has the name that was valid at its time, also those still open at the rename."""
    src, items, root = work_path(spark, "samples"), work_path(spark, "items"), work_path(spark, "named")
    data = table(spark, sf, "events").select("ts", "user_id", "event_type", "value")
    parts = table(spark, sf, "part").where("p_size < 25").select(F.col("p_partkey").alias("itemid"), F.col("p_name").alias("key_"))
    renamed = parts.withColumn("key_", F.when(F.col("itemid") % 2 == 0, F.concat("key_", F.lit(" (new)"))).otherwise(F.col("key_")))
    check, cut = work_path(spark, "named-checkpoint"), tf.ntz(RENAMED)

    def each(batch, batch_id):
        named = dimensions.keyed(batch, dimensions.versions(spark, items))
        named.groupBy("host", "key_", "bucket").agg((F.sum("total") / F.sum("n")).alias("value"), F.sum("n").alias("n")).write.mode(
            "overwrite").parquet(f"{root}/batch_id={batch_id}")

    for snapshot, since, part in ((parts, tf.ntz("2024-01-01 00:00:00"), F.col("ts") < cut), (renamed, cut, F.col("ts") >= cut)):
        dimensions.publish(snapshot, items, since)
        data.where(part).write.mode("append").parquet(src)
        stream = spark.readStream.schema(data.schema).parquet(src).select(
            roles.host_of_user().alias("host"), F.col("user_id").alias("itemid"), F.col("event_type").alias("name"), tf.as_instant(F.col("ts")).alias("ts"), "value")
        sums = stream.withWatermark("ts", DELAY).groupBy("host", "itemid", "name", F.window("ts", "1 hour").alias("_w")).agg(
            F.sum("value").alias("total"), F.count(F.lit(1)).alias("n")).select("host", "itemid", "name", tf.from_instant(F.col("_w.start")).alias("bucket"), "total", "n")
        drain(sums, "named", each=each, checkpoint=check)
    return rounded(spark.read.parquet(root).select("host", "key_", "bucket", "value", "n"), "value")


@query("stream_progress", """SELECT count(*) AS input_rows, count(*) FILTER (value > 100) AS bad_lines, count(*) FILTER (value <= 100) AS good_lines FROM events""")
def stream_progress(spark, sf):
    """What a query listener has logged of a drained stream, summed up."""
    path, name = work_path(spark, "progress"), f"lines_{uuid.uuid4().hex[:8]}"
    text = F.to_json(F.struct(F.struct("host").alias("host"), F.col("event_id").alias("itemid"), "value"))
    lines = event_stream(spark, sf).select(F.when(F.col("value") > 100, F.regexp_replace(text, "}$", "")).otherwise(text).alias("line"))
    log = progress.ProgressLog(spark, path, name)
    spark.streams.addListener(log)
    try:
        drain(live.observed(live.parse_lines(lines)).select("is_bad"), "progress", name=name)
        log.ended.wait(60)
    finally:
        spark.streams.removeListener(log)
    return progress.health(progress.progress(spark, path)).select("input_rows", "bad_lines", "good_lines")


@query("stream_late_drop", f"""WITH {S} SELECT host, count(*) AS n_buckets, sum(n)::BIGINT AS n_samples FROM (
 SELECT host, key_, bucket, count(*) AS n FROM s GROUP BY 1, 2, 3 HAVING bucket + INTERVAL 1 HOUR <= {LAST}) GROUP BY host""")
def stream_late_drop(spark, sf):
    """The table in three deliveries: the first two weeks, the rest, and then
    old samples again.  The last ones lie beyond the watermark."""
    src = work_path(spark, "deliveries")
    data = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    cut = tf.ntz("2024-01-15 00:00:00")
    checkpoint, out = work_path(spark, "late-checkpoint"), work_path(spark, "late")
    for part in (data.where(F.col("ts") < cut), data.where(F.col("ts") >= cut), data.where(F.col("ts") < cut)):
        part.write.mode("append").parquet(src)
        stream = spark.readStream.schema(data.schema).parquet(src).select(
            roles.host_of_user().alias("host"), F.col("event_type").alias("key_"), tf.as_instant(F.col("ts")).alias("ts"), "value"
        )
        means = live.closed_means(stream.withWatermark("ts", DELAY), width="1 hour")
        drain(means, "late", checkpoint=checkpoint, out=out)
    return spark.read.schema(means.schema).parquet(out).groupBy("host").agg(
        F.count(F.lit(1)).alias("n_buckets"), F.sum("n").alias("n_samples")
    )
