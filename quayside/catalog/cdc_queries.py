"""Registered CDC and streaming queries and their oracle SQL."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from quayside.oracle import models_sql  # noqa: F401
from quayside.oracle.ctes import cte, with_ctes
from quayside.operators.ranking import exact_median, value_counts
from quayside.plans.warehouse import Warehouse
from quayside.registry import register
from quayside.session import scratch_path
from quayside.sources.testdata import read_table
from quayside.streaming import cdc
from quayside.plans.analytics import Analytics
from quayside.sources import feed as feed_log
from quayside.streaming import jobs, registry
from quayside.streaming.batches import read_batches, stream_name, write_batch

ISO_SQL = "'%Y-%m-%dT%H:%M:%SZ'"
MERGE_CUT = _dt.datetime(1998, 1, 1)
# load stamps of the first delivery and of its replay, passed in so that results are repeatable
LOADED_AT, REPLAYED_AT = _dt.datetime(2002, 1, 1), _dt.datetime(2002, 1, 2)


def _feed(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    return cdc.build_feed(w.stg_orders, w.stg_order_events)


def _item_feed(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    return cdc.build_item_feed(w.stg_order_items, w.stg_orders)


def _payment_feed(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    return cdc.build_payment_feed(w.stg_payments, w.stg_payment_events, w.stg_orders)


def _changes(spark, sf_dir):
    return cdc.good_changes(cdc.parse_envelope(_feed(spark, sf_dir)))


cte("cdc_orders", "SELECT *, CAST(order_id AS BIGINT) AS k FROM stg_orders")
cte("cdc_expected", f"""
SELECT k * 10 AS kafka_offset, 'c' AS op, epoch_ms(order_date) AS ts_ms, order_id, CAST(NULL AS VARCHAR) AS before_state,
       'placed' AS after_state, total_amount AS after_total_amount, order_date AS after_updated_at, false AS is_tombstone,
       CAST(NULL AS VARCHAR) AS before_raw, strftime(order_date, {ISO_SQL}) AS after_raw, k
FROM cdc_orders WHERE k % 200 <> 1
UNION ALL
SELECT k * 10 + 5, 'c', epoch_ms(order_date), order_id, NULL, 'placed', total_amount, order_date, false, NULL,
       strftime(order_date, {ISO_SQL}), k
FROM cdc_orders WHERE k % 70 = 3
UNION ALL
SELECT k * 10 + 8, 'd', epoch_ms(updated_at + INTERVAL 1 DAY), order_id, order_state, NULL, NULL, NULL, false,
       strftime(updated_at, {ISO_SQL}), NULL, k
FROM cdc_orders WHERE k % 100 = 0
UNION ALL
SELECT k * 10 + 9, NULL, NULL, order_id, NULL, NULL, NULL, NULL, true, NULL, NULL, k FROM cdc_orders WHERE k % 400 = 3
UNION ALL
SELECT o.k * 10 + CAST(split_part(e.event_id, '-', 2) AS BIGINT), 'u', epoch_ms(e.event_timestamp), e.order_id,
       e.previous_state, e.new_state, o.total_amount, e.event_timestamp, false,
       strftime(coalesce(lag(e.event_timestamp) OVER (PARTITION BY e.order_id ORDER BY e.event_timestamp, e.event_id),
                         o.order_date), {ISO_SQL}),
       strftime(e.event_timestamp, {ISO_SQL}), o.k
FROM stg_order_events e JOIN cdc_orders o ON e.order_id = o.order_id
""")
cte("cdc_merged", """
SELECT t.order_id, o.customer_id, after_state AS order_state, after_total_amount AS total_amount, after_updated_at AS updated_at,
       ts_ms AS _cdc_ts_ms, kafka_offset AS _cdc_offset, TIMESTAMP '2002-01-01 00:00:00' AS _cdc_loaded_at
FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ts_ms DESC, kafka_offset DESC) AS rn
      FROM cdc_expected WHERE op IN ('c', 'u', 'r') AND NOT is_tombstone) t JOIN cdc_orders o ON o.order_id = t.order_id WHERE rn = 1
""")

PARSE_COLS = ["kafka_offset", "op", "ts_ms", "order_id", "before_state", "after_state", "after_total_amount",
              "after_updated_at", "is_tombstone"]


@register("cdc_parse", with_ctes(f"SELECT {', '.join(PARSE_COLS)} FROM cdc_expected", "cdc_expected"))
def cdc_parse(spark, sf_dir):
    return _changes(spark, sf_dir).select(*PARSE_COLS)


@register("cdc_dead_letter", with_ctes("""
SELECT 'retail.public.orders' AS topic, k * 10 AS kafka_offset, 'malformed_json' AS reason FROM cdc_orders WHERE k % 200 = 1
UNION ALL
SELECT 'retail.public.orders', k * 10 + 6, 'unknown_op' FROM cdc_orders WHERE k % 300 = 2""", "cdc_orders"))
def cdc_dead_letter(spark, sf_dir):
    return cdc.dead_letters(cdc.parse_envelope(_feed(spark, sf_dir))).drop("raw_value")


@register("cdc_op_counts", with_ctes("""
SELECT 'orders' AS table_name, op, count(*) AS events FROM cdc_expected WHERE NOT is_tombstone GROUP BY op
UNION ALL SELECT 'order_items', 'c', count(*) FROM stg_order_items JOIN stg_orders USING (order_id)
UNION ALL SELECT 'payments', 'c', count(*) FROM stg_payments JOIN stg_orders USING (order_id)
UNION ALL SELECT 'payments', 'u', count(*) FROM stg_payment_events JOIN stg_payments USING (payment_id)""",
                                     "cdc_expected", "stg_orders", "stg_order_items", "stg_payments", "stg_payment_events"))
def cdc_op_counts(spark, sf_dir):
    feeds = [(cdc.ORDERS, _feed(spark, sf_dir)), (cdc.ORDER_ITEMS, _item_feed(spark, sf_dir)), (cdc.PAYMENTS, _payment_feed(spark, sf_dir))]
    each = [cdc.good_changes(cdc.parse_envelope(feed, t)).filter(~F.col("is_tombstone")).select("table_name", "op") for t, feed in feeds]
    return each[0].unionByName(each[1]).unionByName(each[2]).groupBy("table_name", "op").agg(F.count(F.lit(1)).alias("events"))


@register("cdc_field_diff", with_ctes("""
SELECT kafka_offset, order_id, 'order_state' AS field, before_state AS old_value, after_state AS new_value
FROM cdc_expected WHERE op = 'u' AND before_state IS DISTINCT FROM after_state
UNION ALL
SELECT kafka_offset, order_id, 'updated_at', before_raw, after_raw
FROM cdc_expected WHERE op = 'u' AND before_raw IS DISTINCT FROM after_raw""", "cdc_expected"))
def cdc_field_diff(spark, sf_dir):
    d = cdc.field_diff(_changes(spark, sf_dir))
    return d.select("kafka_offset", F.col("record_key").alias("order_id"), "field", "old_value", "new_value")


@register("cdc_change_records", with_ctes("""
SELECT 'retail.public.orders' AS topic, kafka_offset, 'orders' AS table_name, 'u' AS op, order_id AS record_key, 'order_state' AS field,
       before_state AS old_value, after_state AS new_value
FROM cdc_expected WHERE op = 'u' AND before_state IS DISTINCT FROM after_state
UNION ALL
SELECT 'retail.public.orders', kafka_offset, 'orders', 'u', order_id, 'updated_at', before_raw, after_raw
FROM cdc_expected WHERE op = 'u' AND before_raw IS DISTINCT FROM after_raw
UNION ALL
SELECT 'retail.public.payments', CAST(split_part(e.event_id, '-', -1) AS BIGINT), 'payments', 'u', e.payment_id, 'payment_state',
       e.previous_state, e.new_state
FROM stg_payment_events e JOIN stg_payments USING (payment_id) JOIN stg_orders USING (order_id)
WHERE e.previous_state IS DISTINCT FROM e.new_state""",
                                          "cdc_expected", "stg_payment_events", "stg_payments", "stg_orders"))
def cdc_change_records(spark, sf_dir):
    """The change records of every captured table, each with its own key."""
    feeds = [(cdc.ORDERS, _feed(spark, sf_dir)), (cdc.ORDER_ITEMS, _item_feed(spark, sf_dir)), (cdc.PAYMENTS, _payment_feed(spark, sf_dir))]
    each = [cdc.field_diff(cdc.good_changes(cdc.parse_envelope(f, t), t)) for t, f in feeds]
    return each[0].unionByName(each[1]).unionByName(each[2])


def _streamed(spark, sf_dir):
    """Streaming merge: the feed lands in two loads (before / after a cut), a
    file-source stream applies their files in micro-batches, then a second
    stream with a fresh checkpoint replays everything: the target must not
    change (at-least-once delivery + idempotent merge)."""
    feed = _feed(spark, sf_dir)
    path = scratch_path(spark, "cdc-feed")
    cut = F.lit(MERGE_CUT)
    feed_log.write_messages(feed.filter(F.col("kafka_timestamp") < cut), path)
    feed_log.write_messages(feed.filter(F.col("kafka_timestamp") >= cut), path)
    root = scratch_path(spark, "cdc-orders")
    for stamp in (LOADED_AT, REPLAYED_AT):
        jobs.run_cdc_merge(jobs.file_feed(spark, path, max_files=10), root, scratch_path(spark, "cdc-ckpt"), stamp)
    return root


@register("cdc_merge", with_ctes("SELECT * FROM cdc_merged", "cdc_merged"))
def cdc_merge(spark, sf_dir):
    return jobs.merged_table(spark, _streamed(spark, sf_dir))


def _merged_table(spark, feed, captured):
    """The feed merged by the stream, delivered twice."""
    path = scratch_path(spark, f"cdc-feed-{captured.table}")
    feed_log.write_messages(feed, path)
    root = scratch_path(spark, f"cdc-{captured.table}")
    for stamp in (LOADED_AT, REPLAYED_AT):
        jobs.run_cdc_merge(jobs.file_feed(spark, path, max_files=10), root, scratch_path(spark, "cdc-ckpt"), stamp, captured)
    return jobs.merged_table(spark, root, captured)


@register("cdc_merge_order_items", with_ctes("""
SELECT i.order_item_id, i.order_id, i.product_id, i.quantity, i.unit_price, i.line_total AS total_price,
       epoch_ms(o.order_date) AS _cdc_ts_ms, n - 1 AS _cdc_offset, TIMESTAMP '2002-01-01 00:00:00' AS _cdc_loaded_at
FROM (SELECT *, row_number() OVER (PARTITION BY order_item_id ORDER BY product_id, quantity, unit_price, line_total) AS n,
             count(*) OVER (PARTITION BY order_item_id) AS c FROM stg_order_items) i
JOIN stg_orders o USING (order_id) WHERE n = c""", "stg_order_items", "stg_orders"))
def cdc_merge_order_items(spark, sf_dir):
    return _merged_table(spark, _item_feed(spark, sf_dir), cdc.ORDER_ITEMS)


@register("cdc_merge_payments", with_ctes("""
SELECT p.* EXCLUDE (payment_state, order_date), coalesce(l.state, 'pending') AS payment_state,
       coalesce(l.ms, epoch_ms(p.order_date)) AS _cdc_ts_ms, coalesce(l.seq, 0) AS _cdc_offset,
       TIMESTAMP '2002-01-01 00:00:00' AS _cdc_loaded_at
FROM (SELECT p.*, o.order_date FROM stg_payments p JOIN stg_orders o USING (order_id)) p
LEFT JOIN (SELECT payment_id, arg_max(new_state, (ms, seq)) AS state, max(ms) AS ms, arg_max(seq, (ms, seq)) AS seq
           FROM (SELECT *, epoch_ms(event_timestamp) AS ms, CAST(split_part(event_id, '-', -1) AS BIGINT) AS seq
                 FROM stg_payment_events) GROUP BY 1) l USING (payment_id)""", "stg_payments", "stg_payment_events", "stg_orders"))
def cdc_merge_payments(spark, sf_dir):
    return _merged_table(spark, _payment_feed(spark, sf_dir), cdc.PAYMENTS)


@register("cdc_stream_sinks", with_ctes("""
SELECT 'dead letter' AS sink, reason AS kind, count(*) AS n FROM (
  SELECT 'malformed_json' AS reason FROM cdc_orders WHERE k % 200 = 1
  UNION ALL SELECT 'unknown_op' FROM cdc_orders WHERE k % 300 = 2) t GROUP BY 2
UNION ALL
SELECT 'change log', field, count(*) FROM (
  SELECT 'order_state' AS field FROM cdc_expected WHERE op = 'u' AND before_state IS DISTINCT FROM after_state
  UNION ALL SELECT 'updated_at' FROM cdc_expected WHERE op = 'u' AND before_raw IS DISTINCT FROM after_raw) t GROUP BY 2""",
                                        "cdc_expected", "cdc_orders"))
def cdc_stream_sinks(spark, sf_dir):
    """What the stream's dead-letter and change-log tables hold, after a replay."""
    root = _streamed(spark, sf_dir)
    d = jobs.dead_table(spark, root).groupBy(F.col("reason").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    c = jobs.change_table(spark, root).groupBy(F.col("field").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    return d.select(F.lit("dead letter").alias("sink"), "kind", "n").unionByName(c.select(F.lit("change log").alias("sink"), "kind", "n"))


@register("cdc_reconcile", with_ctes("""
SELECT * FROM (
  SELECT coalesce(l.order_id, m.order_id) AS order_id, m.order_state AS cdc_state, l.logged_state,
         CASE WHEN m.order_state IS NULL THEN 'missing_in_cdc'
              WHEN l.logged_state IS NULL AND m.order_state <> 'placed' THEN 'missing_in_log'
              WHEN m.order_state <> l.logged_state THEN 'state_mismatch' END AS issue
  FROM (SELECT order_id, arg_max(new_state, (event_timestamp, event_id)) AS logged_state FROM stg_order_events GROUP BY 1) l
  FULL OUTER JOIN (SELECT * FROM cdc_merged WHERE CAST(order_id AS BIGINT) % 90 <> 5) m ON l.order_id = m.order_id) t
WHERE issue IS NOT NULL""", "cdc_merged", "stg_order_events"))
def cdc_reconcile(spark, sf_dir):
    """The merged table, from which some orders were lost (planted), against the
    last states of the event log."""
    merged = cdc.merge_batch(None, _changes(spark, sf_dir), LOADED_AT).filter(F.col("order_id").cast("long") % 90 != 5)
    return cdc.reconcile(merged, Analytics(Warehouse(spark, sf_dir)).latest_order_state())


@register("cdc_lag", with_ctes("""
SELECT min(lag_ms) AS min_lag_ms, median(CAST(lag_ms AS DOUBLE)) AS median_lag_ms, max(lag_ms) AS max_lag_ms
FROM (SELECT epoch_ms(_cdc_loaded_at) - _cdc_ts_ms AS lag_ms FROM cdc_merged) t""", "cdc_merged"))
def cdc_lag(spark, sf_dir):
    """From the time of the change at its source to the time it was loaded."""
    merged = cdc.merge_batch(None, _changes(spark, sf_dir), LOADED_AT)
    lag = value_counts(merged.select((F.unix_millis("_cdc_loaded_at") - F.col("_cdc_ts_ms")).alias("lag_ms")), "lag_ms")
    mm = lag.agg(F.min("lag_ms").alias("min_lag_ms"), F.max("lag_ms").alias("max_lag_ms"))
    return mm.crossJoin(exact_median(lag, "lag_ms", "median_lag_ms", count="n"))


@register("cdc_wire_header", with_ctes("""
SELECT kafka_offset, 0 AS magic_byte, 1 AS schema_id, true AS payload_ok FROM cdc_expected WHERE NOT is_tombstone
UNION ALL SELECT k * 10, 0, 1, true FROM cdc_orders WHERE k % 200 = 1
UNION ALL SELECT k * 10 + 6, 0, 1, true FROM cdc_orders WHERE k % 300 = 2""", "cdc_expected", "cdc_orders"))
def cdc_wire_header(spark, sf_dir):
    return cdc.parse_wire(cdc.frame_wire(_feed(spark, sf_dir)))


# ---- messages decoded by their schema id -----------------------------------
#: id, subject, version and schema of the order messages (3 has lost a column).
REGISTERED = (
    (1, "orders", 1, "order_id string not null, customer_id string, order_state string, line_count int, total_amount decimal(10,2)"),
    (2, "orders", 2, "order_id string not null, customer_id string, order_state string, line_count bigint, total_amount decimal(12,2), channel string"),
    (3, "orders", 0, "order_id string not null, customer_id string, order_state string, line_count int, total_amount decimal(10,2), legacy string"),
    (7, "payments", 1, "payment_id string not null"),
)


def _decoded(spark, sf_dir):
    """Order images, each written with one of three schema ids, some with an id
    nobody registered, another magic byte or a torn payload."""
    w = Warehouse(spark, sf_dir)
    k = F.col("order_id").cast("long")
    sid = F.when(k % 60 == 5, 9).when(k % 50 == 4, 3).when(k % 2 == 0, 2).otherwise(1)
    cols = ["order_id", "customer_id", "order_state", F.col("line_count").cast("int").alias("line_count"), "total_amount"]
    old = F.to_json(F.struct(*cols))
    new = F.to_json(F.struct(*cols, F.when(k % 3 == 0, F.lit("web")).alias("channel")))
    payload = F.when(k % 70 == 6, F.substring(old, 1, 30)).when(sid == 2, new).otherwise(old)
    framed = registry.frame(sid, payload)
    framed = F.when(k % 80 == 7, F.concat(F.unhex(F.lit("01")), F.expr("substring(framed, 2)"))).otherwise(F.col("framed"))
    feed = (w.int_orders_enriched.withColumn("framed", registry.frame(sid, payload)).withColumn("framed", framed)
            .select(k.alias("kafka_offset"), "framed"))
    known = registry.load(spark.createDataFrame(REGISTERED, "schema_id int, subject string, version int, schema string"))
    return registry.decode(feed, known, "orders")


_SENT = """
SELECT CAST(order_id AS BIGINT) AS k, order_id, customer_id, order_state, line_count, total_amount,
       CASE WHEN CAST(order_id AS BIGINT) % 60 = 5 THEN 9 WHEN CAST(order_id AS BIGINT) % 50 = 4 THEN 3
            WHEN CAST(order_id AS BIGINT) % 2 = 0 THEN 2 ELSE 1 END AS sid
FROM int_orders_enriched"""
cte("sent_messages", _SENT)


@register("cdc_decode_versions", with_ctes("""
SELECT k AS kafka_offset, CAST(sid AS BIGINT) AS schema_id, order_id, customer_id, order_state, CAST(line_count AS BIGINT) AS line_count,
       total_amount, CASE WHEN sid = 2 AND k % 3 = 0 THEN 'web' END AS channel
FROM sent_messages WHERE sid IN (1, 2) AND k % 70 <> 6 AND k % 80 <> 7""", "sent_messages"))
def cdc_decode_versions(spark, sf_dir):
    """Two versions of a schema in one feed, read as the newest."""
    return _decoded(spark, sf_dir)[0]


@register("cdc_decode_dead", with_ctes("""
SELECT k AS kafka_offset, CAST(sid AS BIGINT) AS schema_id,
       CASE WHEN k % 80 = 7 THEN 'bad_frame' WHEN sid = 9 THEN 'unknown_schema' WHEN sid = 3 THEN 'incompatible_schema' ELSE 'bad_payload' END AS reason
FROM sent_messages WHERE k % 80 = 7 OR sid IN (3, 9) OR k % 70 = 6""", "sent_messages"))
def cdc_decode_dead(spark, sf_dir):
    return _decoded(spark, sf_dir)[1]


# ---- event streams ---------------------------------------------------------
@register("stream_events_daily", """
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start,
       CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL 1 DAY AS window_end,
       event_type, count(*) AS events
FROM events GROUP BY 1, 2, 3""")
def stream_events_daily(spark, sf_dir):
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    read_table(spark, sf_dir, "events")   # pins the session to UTC
    root = scratch_path(spark, "events-daily")
    jobs.run_events_daily(jobs.events_stream(spark, path), root, scratch_path(spark, "events-daily-ckpt"))
    return jobs.daily_counts(spark, root)


SLICES = 3
_SLICED = """
WITH b AS (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM events),
e AS (SELECT events.*, (epoch_us(ts) - lo) * 3 // (hi - lo + 1) AS slice FROM events, b),
a AS (SELECT *, CASE WHEN slice = 0 AND event_id % 40 = 7 THEN 2 ELSE slice END AS arrival FROM e),
marks AS (SELECT max(ts) FILTER (arrival < 2) - INTERVAL 3 DAY AS mark FROM a),
sorted AS (SELECT a.*, arrival = 2 AND CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY <= mark AS late FROM a, marks)
"""


def _arrivals(spark, sf_dir):
    """The events in three arrivals by time; of the first, every fortieth comes
    with the last."""
    e = read_table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    lo, hi = e.agg(F.unix_micros(F.min("ts")), F.unix_micros(F.max("ts"))).first()
    part = F.expr(f"(unix_micros(ts) - {lo}) * {SLICES} div ({hi} - {lo} + 1)")
    return e.withColumn("slice", part).withColumn(
        "arrival", F.when((F.col("slice") == 0) & (F.col("event_id") % 40 == 7), SLICES - 1).otherwise(F.col("slice")))


def _arrive(spark, sf_dir, name, job, again=False):
    """Each arrival is written and the job started again, with one checkpoint.
    ``again``: every event comes twice, odd ids with the next arrival."""
    rows, path, ckpt = _arrivals(spark, sf_dir), scratch_path(spark, name), scratch_path(spark, f"{name}-ckpt")
    for i in range(SLICES):
        now = rows.filter(F.col("slice" if again else "arrival") == i)
        if again:
            odd, last = F.col("event_id") % 2 == 1, i == SLICES - 1
            now = now.unionByName(now.filter(~odd | F.lit(last)))
            if i:
                now = now.unionByName(rows.filter((F.col("slice") == i - 1) & odd))
        now.select(*jobs.EVENT_COLUMNS).write.mode("append").parquet(path)
        job(jobs.events_stream(spark, path), ckpt)


@register("stream_days_closed", _SLICED + """
SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS window_start, CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY AS window_end,
       event_type, count(*) AS events
FROM sorted WHERE NOT late GROUP BY 1, 2, 3
HAVING window_end <= (SELECT max(ts) - INTERVAL 3 DAY FROM events)""")
def stream_days_closed(spark, sf_dir):
    """Days the watermark has passed, each written once, over three arrivals with
    a restart after each; late rows count for no day."""
    out = scratch_path(spark, "days-closed")
    _arrive(spark, sf_dir, "days-closed-in", lambda events, ckpt: jobs.run_closed_days(events, out, ckpt))
    return spark.read.schema(jobs.DAILY).parquet(out)


@register("stream_late_events", _SLICED + """
SELECT event_type, count(*) AS late_events, min(ts) AS first_ts, max(ts) AS last_ts FROM sorted WHERE late GROUP BY event_type""")
def stream_late_events(spark, sf_dir):
    """What the closed days leave out, counted apart."""
    root = scratch_path(spark, "late-events")
    _arrive(spark, sf_dir, "late-in", lambda events, ckpt: jobs.run_late_events(events, root, ckpt))
    late = jobs.late_rows(spark, root, _arrivals(spark, sf_dir).select(*jobs.EVENT_COLUMNS).schema)
    return late.groupBy("event_type").agg(F.count(F.lit(1)).alias("late_events"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@register("stream_dedup", "SELECT event_id, ts, user_id, event_type, value FROM events")
def stream_dedup(spark, sf_dir):
    """Every event delivered twice, over three arrivals with a restart after each."""
    out = scratch_path(spark, "events-dedup")
    _arrive(spark, sf_dir, "dedup-in", lambda events, ckpt: jobs.run_dedup(events, out, ckpt), again=True)
    return spark.read.parquet(out).select(*jobs.EVENT_COLUMNS)


# ---- the offset-addressed feed ----------------------------------------------
cte("cdc_messages", """
SELECT e.order_id AS key, kafka_offset, coalesce(make_timestamp_ms(ts_ms), o.order_date) + to_seconds(e.k % 7) AS kafka_timestamp
FROM cdc_expected e JOIN cdc_orders o ON e.order_id = o.order_id
UNION ALL SELECT order_id, k * 10, order_date + to_seconds(k % 7) FROM cdc_orders WHERE k % 200 = 1
UNION ALL SELECT order_id, k * 10 + 6, order_date + to_seconds(k % 7) FROM cdc_orders WHERE k % 300 = 2
""")
FEED_SCHEMA = "topic string, offset long, timestamp timestamp, key string, value string, partition int"
_PLACED = f"""
SELECT row_number() OVER (ORDER BY kafka_timestamp >= TIMESTAMP '{MERGE_CUT:%Y-%m-%d %H:%M:%S}', kafka_timestamp, kafka_offset, key) - 1 AS "offset",
       key, kafka_timestamp, 1 AS deliveries FROM cdc_messages"""


def _consume(spark, sf_dir, start):
    """The log filled by two appends; the consumer runs after the first, after the
    second and once more."""
    # stored once: each append sorts its messages, which reads them twice
    staged, cut = scratch_path(spark, "feed-messages"), F.lit(MERGE_CUT)
    feed_log.write_messages(_feed(spark, sf_dir), staged)
    messages = spark.read.parquet(staged)
    log, root, ckpt = (scratch_path(spark, f"feed-{x}") for x in ("log", "out", "ckpt"))
    name, end = stream_name(ckpt), 0
    for part in (messages.filter(F.col("kafka_timestamp") < cut), messages.filter(F.col("kafka_timestamp") >= cut), None):
        if part is not None:
            end = feed_log.append_feed(part, log, first=end)
        rows = feed_log.read_feed(spark, log, start, ckpt)
        jobs._run(rows.writeStream.foreachBatch(lambda batch, i: write_batch(batch, root, name, i)), ckpt)
    got = read_batches(spark, root, spark.createDataFrame([], FEED_SCHEMA).schema)
    return got.groupBy("offset", "key", F.col("timestamp").alias("kafka_timestamp")).agg(F.count(F.lit(1)).cast("int").alias("deliveries"))


@register("feed_replay", with_ctes(_PLACED, "cdc_messages"))
def feed_replay(spark, sf_dir):
    """From the earliest offsets, over two restarts: every message once."""
    return _consume(spark, sf_dir, "earliest")


@register("feed_tail", with_ctes(f"SELECT * FROM ({_PLACED}) t WHERE kafka_timestamp >= TIMESTAMP '{MERGE_CUT:%Y-%m-%d %H:%M:%S}'", "cdc_messages"))
def feed_tail(spark, sf_dir):
    """From the latest offsets at the start: only what was appended after it."""
    return _consume(spark, sf_dir, "latest")
