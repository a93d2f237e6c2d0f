"""Scans, sinks, projections, joins and the matrix."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsegrid.functions import metrics as mx
from pulsegrid.functions import ratios
from pulsegrid.functions import timeflow as tf
from pulsegrid.operators import asof, intervals, matrix, rolling, warehouse
from pulsegrid.plans import enrich
from pulsegrid.session import materialize, work_path
from pulsegrid.sources import alarms as alarm_days
from pulsegrid.sources import chunks, labels, monitoring, pull
from pulsegrid.suite import roles
from pulsegrid.suite.registry import query
from pulsegrid.suite.roles import GRID, KEYS, ROLL, WIDTH, WIDTHS, rounded, table

START, END = "2024-01-08 00:00:00", "2024-01-22 00:00:00"


# ---- scans ------------------------------------------------------------------

@query("scan_history_range", """
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, l_quantity FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1999-01-01'
  AND l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 20)""")
def scan_history_range(spark, sf):
    active = table(spark, sf, "part").where("p_size < 20").select(F.col("p_partkey").alias("l_partkey"))
    return monitoring.history_range(
        table(spark, sf, "lineitem"), active, tf.ntz("1996-01-01 00:00:00"), tf.ntz("1999-01-01 00:00:00"),
        time="l_shipdate", item="l_partkey",
        columns=("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_quantity"),
    )


@query("pull_orders", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def pull_orders(spark, sf):
    """Orders pulled in eight key ranges, page by page; the first try of every
    range's first page fails."""
    path, failed = f"{sf}/orders.parquet", set()

    def fetch(start, stop, after, limit):
        import pyarrow.dataset as ds

        if after is None and start not in failed:
            failed.add(start)
            raise OSError("connection lost")
        low, key = start if after is None else after + 1, ds.field("o_orderkey")
        got = ds.dataset(path).to_table(columns=["o_orderkey", "o_custkey", "o_totalprice"], filter=(key >= low) & (key < stop)).sort_by("o_orderkey")
        return list(zip(*[c.to_pylist() for c in got.slice(0, limit).columns]))

    span = table(spark, sf, "orders").agg(F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi")).first()
    schema = "o_orderkey bigint, o_custkey bigint, o_totalprice double"
    return pull.pulled(spark, "orders_pages", fetch, schema, span["lo"], span["hi"] + 1, policy=pull.Policy(page=5000, wait=0.05))


@query("scan_trends_range", f"""
WITH {roles.S}, {roles.TR} SELECT host, key_, ts, num, value_min, round(value_avg + 3e-8, 6) AS value_avg, value_max
FROM tr WHERE ts >= TIMESTAMP '{START}' AND ts < TIMESTAMP '{END}'""")
def scan_trends_range(spark, sf):
    hit = monitoring.in_range(roles.trends(spark, sf), "ts", tf.ntz(START), tf.ntz(END))
    return rounded(hit, "value_avg")


@query("scan_events_range", f"""
SELECT event_id, ts, user_id, event_type, value FROM events
WHERE ts >= TIMESTAMP '{START}' AND ts < TIMESTAMP '{END}'""")
def scan_events_range(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return monitoring.in_range(ev, "ts", tf.ntz(START), tf.ntz(END))


@query("scan_problems_range", """
SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority FROM orders
WHERE o_orderstatus = 'P' AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'""")
def scan_problems_range(spark, sf):
    problems = table(spark, sf, "orders").where("o_orderstatus = 'P'")
    return monitoring.in_range(
        problems, "o_orderdate", tf.ntz("1996-01-01 00:00:00"), tf.ntz("1999-01-01 00:00:00")
    ).select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")


@query("snapshot_dims", """
SELECT 'hosts' AS dim, c_custkey AS id, c_name AS name FROM customer WHERE c_nationkey % 3 IN (0, 1)
UNION ALL SELECT 'items', p_partkey, p_name FROM part WHERE p_size < 20
UNION ALL SELECT 'triggers', s_suppkey, s_name FROM supplier
UNION ALL SELECT 'functions', n_nationkey, n_name FROM nation""")
def snapshot_dims(spark, sf):
    pick = lambda t, dim, key, name: t.select(F.lit(dim).alias("dim"), F.col(key).cast("long").alias("id"), F.col(name).alias("name"))
    hosts = table(spark, sf, "customer").withColumn("status", F.col("c_nationkey") % 3)
    items = table(spark, sf, "part").withColumn("status", (F.col("p_size") >= 20).cast("int"))
    hosts = monitoring.snapshot(hosts, ["c_custkey", "c_name"], "status", monitoring.HOST_STATUSES)
    items = monitoring.snapshot(items, ["p_partkey", "p_name"], "status", (monitoring.ITEM_ACTIVE,))
    return warehouse.evolve_union([
        pick(hosts, "hosts", "c_custkey", "c_name"), pick(items, "items", "p_partkey", "p_name"),
        pick(table(spark, sf, "supplier"), "triggers", "s_suppkey", "s_name"),
        pick(table(spark, sf, "nation"), "functions", "n_nationkey", "n_name"),
    ])


# ---- chunks -----------------------------------------------------------------

def day_chunks(spark, sf):
    return roles.samples(spark, sf).withColumn("chunk_id", tf.chunk_id(F.col("ts"), tf.DAY))


SQL_CHUNK = "'chunk_' || (epoch(date_trunc('day', ts))::BIGINT)::VARCHAR || '_' || (epoch(date_trunc('day', ts))::BIGINT + 86400)::VARCHAR"


@query("chunk_roundtrip", f"""
WITH {roles.S} SELECT {SQL_CHUNK} AS chunk_id, count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts,
  round(sum(value) + 3e-6, 4) AS total FROM s GROUP BY 1""")
def chunk_roundtrip(spark, sf):
    path = work_path(spark, "chunks")
    data = day_chunks(spark, sf)
    chunks.write_chunks(data, path)
    # writing a chunk again replaces it
    again = data.where(F.col("ts") >= tf.ntz("2024-01-15 00:00:00"))
    chunks.write_chunks(again, path)
    return rounded(
        chunks.read_chunks(spark, path).groupBy("chunk_id").agg(
            F.count(F.lit(1)).alias("n_rows"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
            F.sum("value").alias("total"),
        ), "total", digits=4,
    )


@query("validate_chunks", f"""
WITH {roles.S}, k AS (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view']) AS table_name),
d AS (SELECT DISTINCT {SQL_CHUNK} AS chunk_id FROM s),
n AS (SELECT {SQL_CHUNK} AS chunk_id, key_ AS table_name, count(*) AS n FROM s WHERE value > 150 GROUP BY 1, 2)
SELECT d.chunk_id, k.table_name, k.table_name = 'click' AS required, coalesce(n.n, 0) AS n_rows,
  CASE WHEN coalesce(n.n, 0) > 0 THEN 'ok' WHEN k.table_name = 'click' THEN 'error' ELSE 'warning' END AS status
FROM d CROSS JOIN k LEFT JOIN n ON n.chunk_id = d.chunk_id AND n.table_name = k.table_name""")
def validate_chunks(spark, sf):
    data = day_chunks(spark, sf)
    counts = data.where("value > 150").groupBy("chunk_id", F.col("key_").alias("table_name")).agg(F.count(F.lit(1)).alias("n"))
    manifest = data.select("chunk_id").distinct().withColumn(
        "table_name", F.explode(F.array(*[F.lit(k) for k in KEYS]))
    ).withColumn("required", F.col("table_name") == "click")
    return chunks.validate(counts, manifest)


@query("load_raw_dedup", f"""
WITH {roles.S}, f AS (SELECT event_id, host, key_, value, {SQL_CHUNK} AS chunk_id, 0 AS part FROM s
  UNION ALL SELECT event_id, host, key_, value + 1, 'chunk_9999999999_9999999999', 1 FROM s WHERE key_ = 'error')
SELECT event_id, host, key_, value, chunk_id FROM f
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY chunk_id DESC) = 1""")
def load_raw_dedup(spark, sf):
    path = work_path(spark, "raw")
    data = day_chunks(spark, sf).drop("ts")
    chunks.write_chunks(data, path)
    later = data.where("key_ = 'error'").withColumns(
        {"value": F.col("value") + 1, "chunk_id": F.lit("chunk_9999999999_9999999999")}
    )
    chunks.write_chunks(later, path)
    return chunks.load_raw(spark, path, ["event_id"])


@query("ledger_skip", f"""
WITH {roles.S} SELECT {SQL_CHUNK} AS chunk_id, count(*) AS row_count FROM s
WHERE ts >= TIMESTAMP '2024-01-11' GROUP BY 1""")
def ledger_skip(spark, sf):
    data = day_chunks(spark, sf)
    ledger = warehouse.ledger_entries(data.where(F.col("ts") < tf.ntz("2024-01-11 00:00:00")))
    return warehouse.ledger_entries(warehouse.pending(data, ledger))


@query("chunk_key", f"""
WITH {roles.S} SELECT {SQL_CHUNK} AS chunk_id, split_part({SQL_CHUNK}, '_', 2)::BIGINT AS start_ts,
  split_part({SQL_CHUNK}, '_', 3)::BIGINT AS end_ts, count(*) AS n FROM s GROUP BY ALL""")
def chunk_key(spark, sf):
    start, end = tf.chunk_bounds(F.col("chunk_id"))
    return day_chunks(spark, sf).groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n")).select(
        "chunk_id", start.alias("start_ts"), end.alias("end_ts"), "n"
    )


# ---- labelled windows -------------------------------------------------------

def window_records(spark, sf):
    """Windows as they stand in the file: some without host or label."""
    e = F.col("event_id")
    return roles.samples(spark, sf).where("key_ = 'purchase' AND value > 100").select(
        F.concat(F.lit("a-"), e).alias("anomaly_id"),
        F.when(e % 2 == 0, "cpu").otherwise("memory").alias("type"),
        F.when(e % 5 != 0, F.col("host")).alias("host"),
        F.when(e % 3 != 0, F.lit("spike")).alias("label"),
        tf.epoch_seconds(F.col("ts")).alias("start_ts"),
        (tf.epoch_seconds(F.col("ts")) + F.lit(36000)).alias("end_ts"),
        F.create_map(F.lit("source"), F.lit("test")).alias("metadata"),
    )


SQL_RECORDS = f"""{roles.S}, rec AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'cpu' ELSE 'memory' END AS type,
  CASE WHEN event_id % 5 <> 0 THEN host ELSE 'main' END AS host,
  CASE WHEN event_id % 3 <> 0 THEN 'spike' WHEN event_id % 2 = 0 THEN 'cpu' ELSE 'memory' END AS label,
  epoch(ts)::BIGINT AS e0, floor(epoch(ts))::BIGINT AS start_ts, floor(epoch(ts))::BIGINT + 36000 AS end_ts
  FROM s WHERE key_ = 'purchase' AND value > 100)"""


@query("gt_windows", f"WITH {SQL_RECORDS} SELECT 'a-' || event_id::VARCHAR AS anomaly_id, type, host, label, start_ts, end_ts, 'test' AS source FROM rec")
def gt_windows(spark, sf):
    path = work_path(spark, "windows")
    window_records(spark, sf).write.json(path)
    return labels.read_windows(spark, path, "main").select(
        "anomaly_id", "type", "host", "label", "start_ts", "end_ts", F.col("metadata")["source"].alias("source")
    )


@query("gt_append_dedup", f"""
WITH {SQL_RECORDS} SELECT type, start_ts, end_ts, label FROM rec WHERE start_ts >= 1705276800""")
def gt_append_dedup(spark, sf):
    # stored: the first half of the month; offered: everything, twice, plus windows that end too early
    offered = window_records(spark, sf).withColumn("label", F.coalesce("label", "type"))
    stored = offered.where("start_ts < 1705276800")
    bad = offered.withColumn("end_ts", F.col("start_ts") - F.lit(1))
    fresh = labels.new_windows(stored, offered.unionByName(offered).unionByName(bad))
    return fresh.select("type", "start_ts", "end_ts", "label")


@query("count_by_label", f"WITH {SQL_RECORDS} SELECT coalesce(CASE WHEN event_id % 3 <> 0 THEN 'spike' END, '?') AS label, count(*) AS n FROM rec GROUP BY 1")
def count_by_label(spark, sf):
    from pulsegrid.operators.reports import count_by_label as by_label
    return by_label(window_records(spark, sf))


# ---- projections and scalar functions ----------------------------------------

SQL_KEYNAME = """CASE user_id % 6 WHEN 0 THEN 'system.cpu.' WHEN 1 THEN 'vm.memory.' WHEN 2 THEN 'vfs.fs.size_hourly_'
  WHEN 3 THEN 'net.if.in.' WHEN 4 THEN 'system.swap.' ELSE 'agent.ping.' END || event_type"""
SQL_IS_METRIC = "(" + " OR ".join(f"starts_with(k, '{p}')" for p in mx.METRIC_PREFIXES) + ") AND NOT contains(k, '_hourly_') AND k NOT IN ('datetime_minute', 'host')"


def key_name():
    u = F.col("user_id") % 6
    names = ["system.cpu.", "vm.memory.", "vfs.fs.size_hourly_", "net.if.in.", "system.swap."]
    case = F.when(u == 0, names[0])
    for i, n in enumerate(names[1:], 1):
        case = case.when(u == i, n)
    return F.concat(case.otherwise("agent.ping."), F.col("event_type"))


@query("metric_key_filter", f"SELECT k AS key_, count(*) AS n FROM (SELECT {SQL_KEYNAME} AS k FROM events) WHERE {SQL_IS_METRIC} GROUP BY k")
def metric_key_filter(spark, sf):
    ev = table(spark, sf, "events").select(key_name().alias("key_"))
    return ev.where(mx.metric_key(F.col("key_"))).groupBy("key_").agg(F.count(F.lit(1)).alias("n"))


SQL_HOSTS = "CASE user_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '  ' WHEN 2 THEN '' ELSE 'h' || (user_id % 5)::VARCHAR END"


@query("nonblank_host", f"SELECT host, count(*) AS n FROM (SELECT {SQL_HOSTS} AS host FROM events) WHERE trim(host) <> '' GROUP BY 1")
def nonblank_host(spark, sf):
    u = F.col("user_id") % 5
    host = F.when(u == 1, "  ").when(u == 2, "").when(u > 2, roles.host_of_user())
    return matrix.named_hosts(table(spark, sf, "events").select(host.alias("host"))).groupBy("host").agg(F.count(F.lit(1)).alias("n"))


@query("sparse_row_filter", f"{roles.WIDE} SELECT host, bucket, " + ", ".join(f"round({k} + 3e-8, 6) AS {k}" for k in KEYS)
       + " FROM m WHERE 2 + " + " + ".join(f"({k} IS NOT NULL)::INT" for k in KEYS) + " >= 4")
def sparse_row_filter(spark, sf):
    return rounded(matrix.drop_sparse(roles.wide(spark, sf), 0.7), *KEYS)


@query("time_split", f"""{roles.WIDE} SELECT CASE WHEN bucket < TIMESTAMP '{roles.SPLIT}' THEN 'train' ELSE 'test' END AS side,
  count(*) AS n_rows, min(bucket) AS lo, max(bucket) AS hi FROM m GROUP BY 1""")
def time_split(spark, sf):
    from pulsegrid.operators.evaluate import time_split as cut
    train, test = cut(roles.wide(spark, sf), roles.split())
    both = train.select(F.lit("train").alias("side"), "bucket").unionByName(test.select(F.lit("test").alias("side"), "bucket"))
    return both.groupBy("side").agg(F.count(F.lit(1)).alias("n_rows"), F.min("bucket").alias("lo"), F.max("bucket").alias("hi"))


@query("time_bucket", """
SELECT event_id, date_trunc('minute', ts) AS minute, date_trunc('hour', ts) AS hour, floor(epoch(ts))::BIGINT AS clock,
  (floor(epoch(ts))::BIGINT // 60) * 60 AS minute_epoch FROM events""")
def time_bucket(spark, sf):
    ts = F.col("ts")
    return table(spark, sf, "events").select(
        "event_id", tf.bucket_start(ts, tf.MINUTE).alias("minute"), tf.bucket_start(ts, tf.HOUR).alias("hour"),
        tf.epoch_seconds(ts).alias("clock"), (tf.bucket_index(ts, 60) * F.lit(60)).alias("minute_epoch"),
    )


@query("epoch_normalize", """
SELECT event_id, CASE event_id % 3 WHEN 2 THEN NULL ELSE floor(epoch(ts))::DOUBLE END AS clock FROM events""")
def epoch_normalize(spark, sf):
    ts = F.col("ts")
    mixed = (
        F.when(F.col("event_id") % 3 == 0, tf.epoch_seconds(ts).cast("string"))
        .when(F.col("event_id") % 3 == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .otherwise("not a time")
    )
    return table(spark, sf, "events").select("event_id", mixed.alias("raw")).select(
        "event_id", tf.mixed_epoch(F.col("raw")).alias("clock")
    )


@query("calendar_features", f"""{roles.WIDE} SELECT host, bucket, extract(hour FROM bucket)::DOUBLE AS hour_of_day,
  (isodow(bucket) - 1)::DOUBLE AS day_of_week, (isodow(bucket) >= 6)::INT::DOUBLE AS is_weekend FROM m""")
def calendar_features(spark, sf):
    return roles.wide(spark, sf).select("host", "bucket").withColumns(tf.calendar(F.col("bucket")))


SQL_NAMES = "SELECT event_type AS key_, CASE user_id % 3 WHEN 0 THEN 'avg' WHEN 1 THEN 'std' ELSE 'trend' END AS stat, (5 * (1 + user_id % 4))::INT AS width FROM events"


def name_parts(spark, sf):
    u = F.col("user_id")
    return table(spark, sf, "events").select(
        F.col("event_type").alias("key_"),
        F.when(u % 3 == 0, "avg").when(u % 3 == 1, "std").otherwise("trend").alias("stat"),
        (F.lit(5) * (F.lit(1) + u % 4)).cast("int").alias("width"),
    )


@query("feature_name_build", f"SELECT key_ || '_' || stat || '_' || width::VARCHAR || 'm' AS feature, count(*) AS n FROM ({SQL_NAMES}) GROUP BY 1")
def feature_name_build(spark, sf):
    name = mx.feature_name(F.col("key_"), F.col("stat"), F.col("width"))
    return name_parts(spark, sf).groupBy(name.alias("feature")).agg(F.count(F.lit(1)).alias("n"))


@query("feature_name_parse", f"""SELECT key_, stat, width, count(*) AS n FROM ({SQL_NAMES}) GROUP BY 1, 2, 3
UNION ALL SELECT NULL, NULL, NULL, count(*) FROM events""")
def feature_name_parse(spark, sf):
    parts = name_parts(spark, sf)
    names = parts.select(mx.feature_name(F.col("key_"), F.col("stat"), F.col("width")).alias("f")).unionByName(
        parts.select(F.col("key_").alias("f"))
    )
    return names.select(*[c.alias(n) for n, c in mx.feature_parts(F.col("f")).items()]).groupBy("key_", "stat", "width").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("json_field", "SELECT event_id, coalesce(CAST(json_extract_string(props, '$.k') AS DOUBLE), 0) AS k, coalesce(json_extract_string(props, '$.host.host'), '') AS host FROM events")
def json_field(spark, sf):
    doc = F.from_json("props", "k string, host struct<host:string>")
    return table(spark, sf, "events").withColumn("d", doc).select(
        "event_id", F.coalesce(F.col("d.k").try_cast("double"), F.lit(0.0)).alias("k"),
        F.coalesce(F.col("d.host.host"), F.lit("")).alias("host"),
    )


# ---- joins --------------------------------------------------------------------

@query("join_fact_dims", """
SELECT l_orderkey, l_linenumber, o_custkey, c_name, l_quantity FROM lineitem
JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""")
def join_fact_dims(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    facts = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return matrix.join_dimensions(facts, [(orders, "l_orderkey"), (customer, "o_custkey")]).select(
        "l_orderkey", "l_linenumber", "o_custkey", "c_name", "l_quantity"
    )


def chain_links(spark, sf):
    return [
        (table(spark, sf, "orders").where("o_orderstatus <> 'P'").select("o_orderkey", "o_custkey"), "l_orderkey", "o_orderkey"),
        (table(spark, sf, "customer").select("c_custkey", "c_nationkey"), "o_custkey", "c_custkey"),
        (table(spark, sf, "nation").where("n_regionkey < 4").select("n_nationkey", "n_name", "n_regionkey"), "c_nationkey", "n_nationkey"),
        (table(spark, sf, "region").select("r_regionkey", "r_name"), "n_regionkey", "r_regionkey"),
    ]


def chain_facts(spark, sf, flag):
    return table(spark, sf, "lineitem").where(F.col("l_returnflag") == flag).select("l_orderkey", "l_shipdate")


SQL_CHAIN = """FROM (SELECT * FROM lineitem WHERE l_returnflag = '{flag}') l
  {how} JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') o ON l.l_orderkey = o.o_orderkey
  {how} JOIN customer ON o_custkey = c_custkey
  {how} JOIN (SELECT * FROM nation WHERE n_regionkey < 4) n ON c_nationkey = n_nationkey
  {how} JOIN region ON n_regionkey = r_regionkey"""


@query("alarm_chain_left", "SELECT l_orderkey, n_name, min(l_shipdate) AS l_shipdate "
       + SQL_CHAIN.format(flag="R", how="LEFT") + " WHERE n_name IS NOT NULL GROUP BY 1, 2")
def alarm_chain_left(spark, sf):
    chain = asof.alarm_chain(chain_facts(spark, sf, "R"), chain_links(spark, sf), "left")
    return asof.distinct_alarms(chain, "l_orderkey", "n_name", "l_shipdate")


@query("alarm_fallback", "SELECT l_orderkey, n_name, min(l_shipdate) AS l_shipdate "
       + SQL_CHAIN.format(flag="A", how="LEFT") + " WHERE n_name IS NOT NULL GROUP BY 1, 2")
def alarm_fallback(spark, sf):
    # no line carries the flag of the primary source, so the other one serves
    links = chain_links(spark, sf)
    primary = asof.alarm_chain(chain_facts(spark, sf, "none"), links, "left")
    other = asof.alarm_chain(chain_facts(spark, sf, "A").where("l_shipdate IS NOT NULL"), links, "left")
    return asof.distinct_alarms(asof.with_fallback(primary, other), "l_orderkey", "n_name", "l_shipdate")


@query("alarm_chain_inner", "SELECT l_orderkey, l_shipdate AS start_ts, l_shipdate + INTERVAL 10 MINUTE AS end_ts "
       + SQL_CHAIN.format(flag="R", how="INNER") + " WHERE n_name = 'NATION_2'")
def alarm_chain_inner(spark, sf):
    chain = asof.alarm_chain(chain_facts(spark, sf, "R"), chain_links(spark, sf), "inner").where("n_name = 'NATION_2'")
    return chain.select("l_orderkey", F.col("l_shipdate").alias("start_ts"), tf.plus_seconds(F.col("l_shipdate"), 600).alias("end_ts"))


@query("semi_active_items", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 20)")
def semi_active_items(spark, sf):
    active = table(spark, sf, "part").where("p_size < 20").select(F.col("p_partkey").alias("l_partkey"))
    return matrix.only_active(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), active, "l_partkey")


@query("join_hourly_trends", f"""{roles.WIDE}, {roles.TR}, t AS (SELECT host, ts, """
       + ", ".join(f"avg(value_{st}) FILTER (key_ = '{k}') AS {k}_hourly_{st}" for k in KEYS for st in ("avg", "min", "max"))
       + " FROM tr GROUP BY 1, 2) SELECT m.host, m.bucket, "
       + ", ".join(f"round(m.{k} + 3e-8, 6) AS {k}" for k in KEYS) + ", "
       + ", ".join(f"round(t.{k}_hourly_{st} + 3e-8, 6) AS {k}_hourly_{st}" for k in KEYS for st in ("avg", "min", "max"))
       + " FROM m LEFT JOIN t ON m.host = t.host AND m.bucket = t.ts")
def join_hourly_trends(spark, sf):
    roll = matrix.pivot_rollups(roles.trends(spark, sf), KEYS)
    out = matrix.attach_rollups(roles.wide(spark, sf), roll)
    return rounded(out, *[c for c in out.columns if c not in ("host", "bucket")])


@query("asof_last_alarm", f"""{roles.WIDE}, {roles.A} SELECT m.host, m.bucket,
  round(coalesce((epoch_us(m.bucket) - epoch_us(a.alarm_ts)) / 60000000.0, 999999) + 3e-8, 6) AS time_since_last_alarm
FROM m ASOF LEFT JOIN a ON m.host = a.host AND m.bucket >= a.alarm_ts""")
def asof_last_alarm(spark, sf):
    rows = roles.wide(spark, sf).select("host", "bucket")
    return rounded(asof.time_since_last_alarm(rows, roles.alarms(spark, sf), **GRID), "time_since_last_alarm")


SQL_SPANS = f"{roles.A}, {roles.W}, sp AS (SELECT host, alarm_ts AS start_ts, alarm_ts + INTERVAL 10 HOUR AS end_ts FROM a UNION ALL SELECT host, start_ts, end_ts FROM w)"


@query("asof_by_day", f"""{roles.WIDE}, {roles.A}
SELECT m.host, m.bucket, round(coalesce((epoch_us(m.bucket) - epoch_us(a.alarm_ts)) / 60000000.0, 999999) + 3e-8, 6) AS time_since_last_alarm
FROM m ASOF LEFT JOIN a ON m.host = a.host AND m.bucket >= a.alarm_ts
WHERE m.bucket >= TIMESTAMP '2024-01-17 06:00:00' AND m.bucket < TIMESTAMP '2024-01-18 18:00:00'""")
def asof_by_day(spark, sf):
    """Two days' rows from the alarms of these days and one carry row per host; the
    alarms came in five deliveries, one of them late."""
    root = work_path(spark, "alarm-days")
    rows = roles.samples(spark, sf).where("key_ = 'error' AND value > 100").select(
        F.col("event_id").alias("eventid"), "host", F.col("ts").alias("alarm_ts"))
    for part in (0, 1, 3, 4, 2):  # thirds of ten days, the third one last
        lo, hi = (tf.plus_seconds(tf.ntz("2024-01-01 00:00:00"), d * tf.DAY) for d in (6 * part, 6 * part + 6))
        alarm_days.add(rows.where((F.col("alarm_ts") >= lo) & (F.col("alarm_ts") < hi)), root)
    known = alarm_days.between(spark, root, "2024-01-17", "2024-01-18")
    m = monitoring.in_range(roles.wide(spark, sf).select("host", "bucket"), "bucket", tf.ntz("2024-01-17 06:00:00"), tf.ntz("2024-01-18 18:00:00"))
    return rounded(asof.time_since_last_alarm(m, known, **GRID), "time_since_last_alarm")


@query("interval_label", f"""{roles.WIDE}, {SQL_SPANS} SELECT host, bucket,
  (EXISTS (SELECT 1 FROM sp WHERE sp.host = m.host AND m.bucket >= sp.start_ts AND m.bucket < sp.end_ts))::INT AS is_anomaly FROM m""")
def interval_label(spark, sf):
    a = roles.alarms(spark, sf)
    spans = a.select("host", F.col("alarm_ts").alias("start_ts"), tf.plus_seconds(F.col("alarm_ts"), 10 * tf.HOUR).alias("end_ts"))
    spans = spans.unionByName(roles.windows(spark, sf).select("host", "start_ts", "end_ts"))
    return intervals.in_any_window(roles.wide(spark, sf).select("host", "bucket"), spans, **GRID)


@query("interval_first_label", f"""{roles.WIDE}, {roles.W} SELECT m.host, m.bucket, (min(w.seq_no) IS NOT NULL)::INT AS y_true,
  coalesce(arg_min(w.label, w.seq_no), '') AS anomaly
FROM m LEFT JOIN w ON w.host = m.host AND m.bucket >= w.start_ts AND m.bucket < w.end_ts GROUP BY 1, 2""")
def interval_first_label(spark, sf):
    return intervals.first_window_label(
        roles.wide(spark, sf), roles.windows(spark, sf), row_key=["host", "bucket"], grid=WIDTH
    )


@query("window_comparison", f"{roles.COMP} SELECT model, seq_no, host, start_ts, end_ts, label, rows_inside, detected_minutes, first_detected FROM c")
def window_comparison(spark, sf):
    return roles.comparison(spark, sf).drop("latency_min", "caught")


@query("detection_latency", f"{roles.COMP} SELECT model, seq_no, latency_min, caught, detected_minutes FROM c")
def detection_latency(spark, sf):
    return roles.comparison(spark, sf).select("model", "seq_no", "latency_min", "caught", "detected_minutes")


@query("alarm_overlap", f"""WITH {roles.S}, {roles.A}, {roles.W}
SELECT seq_no, EXISTS (SELECT 1 FROM a WHERE a.host = w.host AND a.alarm_ts < w.end_ts AND a.alarm_ts + INTERVAL 2 HOUR > w.start_ts) AS own_alarm_overlap,
 EXISTS (SELECT 1 FROM a WHERE a.host = w.host AND ((a.alarm_ts <= w.start_ts AND w.start_ts < a.alarm_ts + INTERVAL 2 HOUR)
   OR (a.alarm_ts <= w.end_ts AND w.end_ts <= a.alarm_ts + INTERVAL 2 HOUR))) AS compat_overlap FROM w""")
def alarm_overlap(spark, sf):
    a, w = roles.alarms(spark, sf), roles.windows(spark, sf)
    both = intervals.alarm_overlap(w, a, alarm_len=2 * tf.HOUR)
    return intervals.alarm_overlap(both, a, alarm_len=2 * tf.HOUR, mode="compat", out="compat_overlap").select(
        "seq_no", "own_alarm_overlap", "compat_overlap"
    )


SQL_UPSERT = f"""{roles.WIDE}, o AS (SELECT host, bucket, click, view FROM m WHERE bucket < TIMESTAMP '2024-01-16'),
 n AS (SELECT host, bucket, click + 1 AS click, error FROM m WHERE bucket >= TIMESTAMP '2024-01-14')"""


def upsert_sides(spark, sf):
    m = roles.wide(spark, sf)
    old = m.where(F.col("bucket") < tf.ntz("2024-01-16 00:00:00")).select("host", "bucket", "click", "view")
    new = m.where(F.col("bucket") >= tf.ntz("2024-01-14 00:00:00")).select("host", "bucket", (F.col("click") + 1).alias("click"), "error")
    return old, new


@query("upsert_matrix", f"""{SQL_UPSERT} SELECT host, bucket, round(click + 3e-8, 6) AS click, round(view + 3e-8, 6) AS view, round(error + 3e-8, 6) AS error FROM (
 SELECT host, bucket, click, view, NULL::DOUBLE AS error FROM o ANTI JOIN n USING (host, bucket)
 UNION ALL SELECT host, bucket, click, NULL, error FROM n)""")
def upsert_matrix(spark, sf):
    return rounded(warehouse.upsert(*upsert_sides(spark, sf), ["host", "bucket"]), "click", "view", "error")


@query("schema_evolve_union", f"""{SQL_UPSERT} SELECT host, bucket, round(click + 3e-8, 6) AS click, round(view + 3e-8, 6) AS view, round(error + 3e-8, 6) AS error FROM (
 SELECT host, bucket, click, view, NULL::DOUBLE AS error FROM o UNION ALL SELECT host, bucket, click, NULL, error FROM n)""")
def schema_evolve_union(spark, sf):
    return rounded(warehouse.evolve_union(upsert_sides(spark, sf)), "click", "view", "error")


@query("archive_purge", f"""{roles.WIDE}, k AS (SELECT max(bucket) - INTERVAL 14 DAY AS cut FROM m)
SELECT count(*) FILTER (bucket < cut) AS archived, max(bucket) FILTER (bucket < cut) AS newest_archived,
 count(*) FILTER (bucket >= cut) AS kept, min(bucket) FILTER (bucket >= cut) AS oldest_kept FROM m, k""")
def archive_purge(spark, sf):
    m = materialize(roles.wide(spark, sf), "archive-source")
    cut = warehouse.retention_cutoff(roles.newest(m), 14)
    return warehouse.archive_and_purge(spark, m, work_path(spark, "archive"), work_path(spark, "kept"), cut)


@query("archive_days", f"""{roles.WIDE}, d AS (SELECT strftime(bucket, '%Y-%m-%d') AS day, bucket FROM m),
 k AS (SELECT strftime(max(bucket) - INTERVAL 14 DAY, '%Y-%m-%d') AS cut FROM m)
SELECT day, count(*) AS n_rows, CASE WHEN day < cut THEN 'archive' ELSE 'table' END AS place FROM d, k GROUP BY day, cut""")
def archive_days(spark, sf):
    """Retention by dropping day partitions: rows per day, and where they are."""
    path, archive = work_path(spark, "by-day"), work_path(spark, "archive")
    m = roles.wide(spark, sf).withColumn("day", F.date_format("bucket", "yyyy-MM-dd"))
    m.write.partitionBy("day").parquet(path)
    newest = spark.read.parquet(path).agg(F.max("bucket").alias("t")).scalar()
    cut = spark.range(1).select(F.date_format(warehouse.retention_cutoff(newest, 14), "yyyy-MM-dd").alias("d")).first()["d"]
    moved = warehouse.archive_days(spark, path, archive, cut)
    kept = spark.read.parquet(path).groupBy(F.col("day").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n_rows"))
    return moved.select("day", F.col("archived").alias("n_rows"), F.lit("archive").alias("place")).unionByName(kept.withColumn("place", F.lit("table")))


# ---- matrix -------------------------------------------------------------------

ROUND_KEYS = ", ".join(f"round({k} + 3e-8, 6) AS {k}" for k in KEYS)


@query("minute_pivot", f"{roles.WIDE} SELECT host, bucket, {ROUND_KEYS} FROM m")
def minute_pivot(spark, sf):
    return rounded(roles.wide(spark, sf), *KEYS)


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("hourly_pivot", """
WITH o AS (SELECT n_name AS host, o_orderpriority AS key_, date_trunc('day', o_orderdate) AS period,
  min(o_totalprice) AS value_min, avg(o_totalprice) AS value_avg, max(o_totalprice) AS value_max
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3)
SELECT host, period, """ + ", ".join(
    f"round(avg(value_{st}) FILTER (key_ = '{k}') + 3e-6, 4) AS \"{k}_hourly_{st}\"" for k in PRIORITIES for st in ("avg", "min", "max"))
    + " FROM o GROUP BY host, period")
def hourly_pivot(spark, sf):
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    nation = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("host"))
    facts = matrix.join_dimensions(table(spark, sf, "orders"), [(customer, "o_custkey"), (nation, "n_nationkey")])
    price = F.col("o_totalprice")
    rolls = facts.groupBy("host", F.col("o_orderpriority").alias("key_"), tf.bucket_start(F.col("o_orderdate"), tf.DAY).alias("ts")).agg(
        F.min(price).alias("value_min"), F.avg(price).alias("value_avg"), F.max(price).alias("value_max")
    )
    out = matrix.pivot_rollups(rolls, PRIORITIES, width=tf.DAY)
    return rounded(out, *[c for c in out.columns if "_hourly_" in c], digits=4)


@query("dedup_keep_last", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1""")
def dedup_keep_last(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return matrix.keep_last(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])


@query("ffill_limit3", f"{roles.WIDE} SELECT host, bucket, " + ", ".join(
    f"round(last_value({k} IGNORE NULLS) OVER f + 3e-8, 6) AS {k}" for k in KEYS)
    + " FROM m WINDOW f AS (PARTITION BY host, date_trunc('day', bucket) ORDER BY bucket ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)")
def ffill_limit3(spark, sf):
    return rounded(matrix.forward_fill(roles.wide(spark, sf), KEYS, limit=3, chunk=tf.DAY), *KEYS)


@query("minute_grid", f"""{roles.WIDE}, e AS (SELECT host, min(bucket) AS lo, max(bucket) AS hi FROM m GROUP BY host),
 g AS (SELECT host, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS bucket FROM e)
SELECT g.host, g.bucket, {", ".join(f"round(m.{k} + 3e-8, 6) AS {k}" for k in KEYS)} FROM g LEFT JOIN m ON m.host = g.host AND m.bucket = g.bucket""")
def minute_grid(spark, sf):
    m = roles.wide(spark, sf)
    grid = rolling.bucket_grid(m, width=WIDTH, block=roles.BLOCK)
    return rounded(grid.join(m, ["host", "bucket"], "left"), *KEYS)


def sql_rolling(stat):
    return f"{roles.WIDE} SELECT host, bucket, " + ", ".join(
        f"round({roles.sql_stat(k, stat, w)} + 3e-8, 6) AS {k}_{stat}_{w}m" for k in KEYS for w in WIDTHS) + " FROM m"


def rolled(spark, sf, stat):
    out = rolling.rolling_stats(roles.wide(spark, sf), KEYS, stats=(stat,), **ROLL).drop(*KEYS)
    return rounded(out, *[c for c in out.columns if c not in ("host", "bucket")])


@query("rolling_avg", sql_rolling("avg"))
def rolling_avg(spark, sf):
    return rolled(spark, sf, "avg")


@query("rolling_std", sql_rolling("std"))
def rolling_std(spark, sf):
    return rolled(spark, sf, "std")


@query("rolling_trend", sql_rolling("trend"))
def rolling_trend(spark, sf):
    return rolled(spark, sf, "trend")


ROLLED_COLS = [f"{k}_{st}_{w}m" for k in KEYS for w in WIDTHS for st in ("avg", "std", "trend")]


@query("rolling_with_history", f"{roles.ROLLED} SELECT host, bucket, " + ", ".join(f"round({c} + 3e-8, 6) AS {c}" for c in ROLLED_COLS)
       + f" FROM r WHERE bucket >= TIMESTAMP '{roles.SPLIT}'")
def rolling_with_history(spark, sf):
    m = roles.wide(spark, sf)
    train, test = m.where(F.col("bucket") < roles.split()), m.where(F.col("bucket") >= roles.split())
    return rounded(rolling.rolling_with_history(test, train, KEYS, **ROLL).drop(*KEYS), *ROLLED_COLS)


@query("coverage_gaps", f"""{roles.WIDE}, g AS (SELECT host, lag(bucket) OVER (PARTITION BY host ORDER BY bucket) AS gap_from, bucket AS gap_to FROM m
 UNION ALL SELECT '*', lag(ts) OVER (ORDER BY ts), ts FROM (SELECT DISTINCT o_orderdate AS ts FROM orders))
SELECT host, gap_from, gap_to, round(epoch(gap_to - gap_from) / 60, 1) AS minutes FROM g
WHERE gap_from IS NOT NULL AND epoch(gap_to - gap_from) / 60 > 70""")
def coverage_gaps(spark, sf):
    per_host = rolling.gaps(roles.wide(spark, sf).select("host", "bucket"))
    overall = table(spark, sf, "orders").select(F.lit("*").alias("host"), F.col("o_orderdate").alias("bucket"))
    return per_host.unionByName(rolling.gaps(overall))


def _steps(seq):
    """Number of steps, first and last value and sum of every key of a sequence."""
    def cells(i: int, k: str) -> list:
        total = F.aggregate("sequence", F.lit(0.0), lambda acc, v: acc + v[i])
        return [roles.rnd(F.element_at("sequence", 1)[i]).alias(f"first_{k}"), roles.rnd(F.element_at("sequence", -1)[i]).alias(f"last_{k}"),
                roles.rnd(total, 4).alias(f"sum_{k}")]

    return seq.select("host", "bucket", F.size("sequence").cast("long").alias("n_steps"), *[c for i, k in enumerate(KEYS) for c in cells(i, k)])


SQL_FILLED = f"{roles.WIDE}, z AS (SELECT host, bucket, epoch(bucket)::BIGINT // 3600 AS pos, " + ", ".join(f"coalesce({k}, 0) AS {k}" for k in KEYS) + " FROM m)"
SQL_STEPS = ", ".join(f"round(first_value({k}) OVER f + 3e-8, 6) AS first_{k}, round(last_value({k}) OVER f + 3e-8, 6) AS last_{k}, round(sum({k}) OVER f + 3e-6, 4) AS sum_{k}" for k in KEYS)


@query("sequence_windows", f"""{SQL_FILLED}
SELECT * FROM (SELECT host, bucket, count(*) OVER f AS n_steps, {SQL_STEPS}
 FROM z WINDOW f AS (PARTITION BY host ORDER BY bucket ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)) WHERE n_steps = 60""")
def sequence_windows(spark, sf):
    m = roles.wide(spark, sf).select("host", "bucket", *KEYS).fillna(0.0)
    return _steps(rolling.sequences(m, KEYS, length=60, width=WIDTH, block=roles.BLOCK))


@query("sequence_by_time", f"""{SQL_FILLED}
SELECT host, bucket, count(*) OVER f AS n_steps, {SQL_STEPS}
FROM z WINDOW f AS (PARTITION BY host ORDER BY pos RANGE BETWEEN 59 PRECEDING AND CURRENT ROW)""")
def sequence_by_time(spark, sf):
    """The serving form: rows of the last 60 buckets, however many there are."""
    m = roles.wide(spark, sf).select("host", "bucket", *KEYS).fillna(0.0)
    return _steps(rolling.sequences(m, KEYS, length=60, width=WIDTH, block=roles.BLOCK, by="time"))


@query("sequence_on_grid", f"""{SQL_FILLED}
SELECT host, bucket, 60::BIGINT AS n_steps, """ + ", ".join(
    f"round(CASE WHEN first_value(pos) OVER f = pos - 59 THEN first_value({k}) OVER f ELSE 0 END + 3e-8, 6) AS first_{k}, round({k} + 3e-8, 6) AS last_{k}, round(sum({k}) OVER f + 3e-6, 4) AS sum_{k}"
    for k in KEYS) + """
FROM z WINDOW f AS (PARTITION BY host ORDER BY pos RANGE BETWEEN 59 PRECEDING AND CURRENT ROW)""")
def sequence_on_grid(spark, sf):
    """The form that streams score: the last 60 buckets, zeros where there is no row."""
    m = roles.wide(spark, sf).select("host", "bucket", *KEYS).fillna(0.0)
    return _steps(rolling.sequences(m, KEYS, length=60, width=WIDTH, block=roles.BLOCK, by="grid"))


# ---- the feature job ------------------------------------------------------------

SQL_ENRICHED = f"""{roles.ROLLED}, {SQL_SPANS},
 f AS (SELECT r.*, round(coalesce((epoch_us(r.bucket) - epoch_us(a.alarm_ts)) / 60000000.0, 999999) + 3e-8, 6) AS time_since_last_alarm,
  (EXISTS (SELECT 1 FROM sp WHERE sp.host = r.host AND r.bucket >= sp.start_ts AND r.bucket < sp.end_ts))::INT AS is_anomaly
  FROM r ASOF LEFT JOIN a ON r.host = a.host AND r.bucket >= a.alarm_ts)
SELECT host, bucket, {", ".join(f"round({c} + 3e-8, 6) AS {c}" for c in ROLLED_COLS)}, time_since_last_alarm, is_anomaly FROM f"""


def enriched(spark, sf):
    # the matrix is a table of its own; features read it, not the raw samples
    matrix_table = materialize(roles.wide(spark, sf), "matrix")
    out = enrich.enriched(
        matrix_table, KEYS, roles.alarms(spark, sf), roles.windows(spark, sf),
        label_seconds=10 * tf.HOUR, **ROLL,
    )
    return rounded(out, *ROLLED_COLS, "time_since_last_alarm")


@query("enriched_features", SQL_ENRICHED)
def enriched_features(spark, sf):
    return enriched(spark, sf)


@query("incremental_features", f"SELECT * FROM ({SQL_ENRICHED}) WHERE bucket >= TIMESTAMP '2024-01-10' AND bucket < TIMESTAMP '2024-01-20'")
def incremental_features(spark, sf):
    out = enrich.enriched_range(
        roles.wide(spark, sf), KEYS, roles.alarms(spark, sf), roles.windows(spark, sf),
        tf.ntz("2024-01-10 00:00:00"), tf.ntz("2024-01-20 00:00:00"), label_seconds=10 * tf.HOUR, **ROLL,
    )
    return rounded(out, *ROLLED_COLS, "time_since_last_alarm")


@query("zscore", f"""{roles.WIDE}, t AS (SELECT {", ".join(f"avg({k}) AS mu_{k}, stddev_pop({k}) AS sd_{k}" for k in KEYS)}
  FROM m WHERE bucket < TIMESTAMP '{roles.SPLIT}')
SELECT host, bucket, {", ".join(f"round(({k} - mu_{k}) / CASE WHEN sd_{k} = 0 THEN 1 ELSE sd_{k} END + 3e-8, 6) AS z_{k}" for k in KEYS)} FROM m, t""")
def zscore(spark, sf):
    m = roles.wide(spark, sf)
    train = m.where(F.col("bucket") < roles.split())
    stat = lambda f, k: train.agg(f(k)).scalar()
    return m.select("host", "bucket", *[
        roles.rnd(ratios.zscore(F.col(k), stat(F.avg, k), stat(F.stddev_pop, k))).alias(f"z_{k}") for k in KEYS])


@query("impute_mean", f"""{roles.WIDE}, t AS (SELECT {", ".join(f"avg({k}) AS mu_{k}" for k in KEYS)} FROM m WHERE bucket < TIMESTAMP '{roles.SPLIT}')
SELECT host, bucket, {", ".join(f"round(coalesce({k}, mu_{k}) + 3e-8, 6) AS {k}_mean, round(coalesce({k}, 0) + 3e-8, 6) AS {k}_zero" for k in KEYS)} FROM m, t""")
def impute_mean(spark, sf):
    m = roles.wide(spark, sf)
    train = m.where(F.col("bucket") < roles.split())
    filled = []
    for k in KEYS:
        filled += [roles.rnd(ratios.impute(F.col(k), train.agg(F.avg(k)).scalar())).alias(f"{k}_mean"),
                   roles.rnd(ratios.impute(F.col(k), None, "zero")).alias(f"{k}_zero")]
    return m.select("host", "bucket", *filled)
