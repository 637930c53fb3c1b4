"""Change-data-capture: envelope parsing, dead letters, field diffs,
replay-safe merge, reconciliation and lag — batch functions that the
Structured Streaming job applies per micro-batch.

Feed layout (one row per message, as a Kafka source would give it):
``topic, kafka_offset, kafka_timestamp, key, value`` where ``value`` is the
JSON change envelope ``{before, after, op, ts_ms, source}`` or NULL
(tombstone).  Decimals arrive as doubles and timestamps as ISO strings
(connector settings) and are cast back on ingest.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.sources import schemas

@dataclass(frozen=True)
class Captured:
    """A table whose changes are captured: its key and its columns' types."""
    table: str
    key: str
    schema: T.StructType

    @property
    def topic(self) -> str:
        return f"retail.public.{self.table}"


ORDER_IMAGE = T.StructType([
    T.StructField("order_id", T.StringType()), T.StructField("customer_id", T.StringType()),
    T.StructField("order_state", T.StringType()), T.StructField("total_amount", T.DoubleType()),
    T.StructField("updated_at", T.StringType())])
ORDERS = Captured("orders", "order_id", T.StructType([
    T.StructField("order_id", T.StringType()), T.StructField("customer_id", T.StringType()),
    T.StructField("order_state", T.StringType()), T.StructField("total_amount", schemas.MONEY),
    T.StructField("updated_at", T.TimestampType())]))
ORDER_ITEMS = Captured("order_items", "order_item_id", schemas.ORDER_ITEMS)
PAYMENTS = Captured("payments", "payment_id", schemas.PAYMENTS)
TABLES = (ORDERS, ORDER_ITEMS, PAYMENTS)

#: Images are read as text by column; ``typed`` gives them their types.
_REST = "op string, ts_ms long, source struct<db:string, table:string>, _corrupt string"
ENVELOPE = f"before map<string,string>, after map<string,string>, {_REST}"
#: The same where rows stand under a record name.
NAMED_ENVELOPE = f"before map<string,map<string,string>>, after map<string,map<string,string>>, {_REST}"
#: How a message with rows under record names usually begins, within its first characters.
NAMED_START = r'\A\{(?:"before":null,)?"(?:before|after)":\{"[^"\\]*\.[^"\\]*":\{'
START = 128
#: Names that mark a nullable value written as {type: value}.
UNION_NAMES = ("null", "boolean", "int", "long", "float", "double", "string", "bytes")
#: A wrapped text without escapes, and any wrapped scalar whose text the parser would give as it stands (numbers as it writes them).
WRAPPED_TEXT = r'\A\{"string":"[^"\\\x00-\x1F]*"\}\z'
WRAPPED_SCALAR = (r'\A\{"(?:' + "|".join(UNION_NAMES) + r')":(?:"([^"\\\x00-\x1F]*)"'
                  r'|(0|-?[1-9][0-9]{0,17}|-?[1-9][0-9]{0,5}\.(?:0|[0-9]{0,7}[1-9])|true|false))\}\z')
OPS = ("c", "u", "d", "r")
ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"
SCHEMA_IDS = {"retail.public.orders": 1, "retail.public.order_items": 2, "retail.public.payments": 3}


# ---- feed (the source database's change stream, derived from its tables) --
def _image(order_id, customer_id, state, total, ts):
    return F.struct(order_id.alias("order_id"), customer_id.alias("customer_id"), state.alias("order_state"),
                    total.cast("double").alias("total_amount"), F.date_format(ts, ISO).alias("updated_at"))


def build_feed(orders: DataFrame, events: DataFrame) -> DataFrame:
    """c per order, u per order event, d / duplicates / truncated JSON /
    unknown op / tombstones planted by ``k % n`` rules (FIXTURES §5)."""
    o = orders.select("order_id", "customer_id", "order_state", "order_date", "updated_at", "total_amount",
                      F.col("order_id").cast("long").alias("k"))
    src = F.struct(F.lit("retail").alias("db"), F.lit("orders").alias("table"))
    k = F.col("k")

    def env(before, after, op, ts):
        return F.to_json(F.struct(before.alias("before"), after.alias("after"), F.lit(op).alias("op"),
                                  F.unix_millis(ts).alias("ts_ms"), src.alias("source")))
    no_img = F.lit(None).cast(ORDER_IMAGE)
    created = _image(F.col("order_id"), F.col("customer_id"), F.lit("placed"), F.col("total_amount"),
                     F.col("order_date"))
    c_json = env(no_img, created, "c", F.col("order_date"))
    msgs = F.array(
        F.struct((k * 10).alias("off"), F.col("order_date").alias("ts"),
                 F.when(k % 200 == 1, F.expr("substring(c_json, 1, 40)")).otherwise(F.col("c_json")).alias("value")),
        F.when(k % 70 == 3, F.struct((k * 10 + 5).alias("off"), F.col("order_date").alias("ts"),
                                     F.col("c_json").alias("value"))),
        F.when(k % 300 == 2, F.struct((k * 10 + 6).alias("off"), F.col("order_date").alias("ts"),
                                      env(no_img, created, "z", F.col("order_date")).alias("value"))),
        F.when(k % 100 == 0, F.struct(
            (k * 10 + 8).alias("off"), (F.col("updated_at") + F.expr("INTERVAL 1 DAY")).alias("ts"),
            env(_image(F.col("order_id"), F.col("customer_id"), F.col("order_state"), F.col("total_amount"),
                       F.col("updated_at")), no_img, "d",
                F.col("updated_at") + F.expr("INTERVAL 1 DAY")).alias("value"))),
        F.when(k % 400 == 3, F.struct((k * 10 + 9).alias("off"), F.col("order_date").alias("ts"),
                                      F.lit(None).cast("string").alias("value"))),
    )
    per_order = o.withColumn("c_json", c_json).select(
        "order_id", "k", F.inline(F.filter(msgs, lambda m: m.isNotNull())))

    w = Window.partitionBy("order_id").orderBy("event_timestamp", "event_id")  # ≤ a handful per order
    e = (events.join(o.select("order_id", "customer_id", "total_amount", "order_date", "k"), "order_id")
         .withColumn("prev_ts", F.coalesce(F.lag("event_timestamp").over(w), F.col("order_date")))
         .withColumn("n", F.split("event_id", "-").getItem(1).cast("long")))
    u = e.select("order_id", "k", (F.col("k") * 10 + F.col("n")).alias("off"), F.col("event_timestamp").alias("ts"),
                 env(_image(F.col("order_id"), F.col("customer_id"), F.col("previous_state"), F.col("total_amount"),
                            F.col("prev_ts")),
                     _image(F.col("order_id"), F.col("customer_id"), F.col("new_state"), F.col("total_amount"),
                            F.col("event_timestamp")), "u", F.col("event_timestamp")).alias("value"))
    allm = per_order.unionByName(u)
    return allm.select(
        F.lit("retail.public.orders").alias("topic"), F.col("off").alias("kafka_offset"),
        F.timestamp_add("SECOND", F.col("k") % 7, F.col("ts")).alias("kafka_timestamp"),
        F.col("order_id").alias("key"), "value")


def _wrapped(t: Captured, **changed: Column) -> Column:
    """A row image as a union-typed source writes it: the row under its record
    name, every nullable value under the name of its type."""
    fields = []
    for f in t.schema.fields:
        v, kind = changed.get(f.name, F.col(f.name)), f.dataType.typeName()
        if isinstance(f.dataType, T.DecimalType):
            v, kind = v.cast("double"), "double"
        elif isinstance(f.dataType, T.TimestampType):
            v, kind = F.date_format(v, ISO), "string"
        elif isinstance(f.dataType, T.IntegerType):
            kind = "int"
        fields.append((F.when(v.isNotNull(), F.struct(v.alias(kind))) if f.nullable else v).alias(f.name))
    return F.struct(F.struct(*fields).alias(f"{t.topic}.Value"))


def _message(t: Captured, op: str, ts: Column, seq: Column, before: Column | None, after: Column) -> list[Column]:
    src = F.struct(F.lit("retail").alias("db"), F.lit(t.table).alias("table"))
    value = F.to_json(F.struct(*([before.alias("before")] if before is not None else []), after.alias("after"),
                               F.lit(op).alias("op"), F.unix_millis(ts).alias("ts_ms"), src.alias("source")))
    return [F.lit(t.topic).alias("topic"), seq.cast("long").alias("kafka_offset"), ts.alias("kafka_timestamp"),
            F.col(t.key).alias("key"), value.alias("value")]


def build_item_feed(items: DataFrame, orders: DataFrame) -> DataFrame:
    """One c per order item, at the time of its order.  The given table repeats
    item ids: the offset is a row's place among those of its id (a handful)."""
    rows = items.withColumnRenamed("line_total", "total_price").join(orders.select("order_id", "order_date"), "order_id")
    place = Window.partitionBy("order_item_id").orderBy("product_id", "quantity", "unit_price", "total_price")
    rows = rows.withColumn("seq", F.row_number().over(place) - 1)
    return rows.select(*_message(ORDER_ITEMS, "c", F.col("order_date"), F.col("seq"), None, _wrapped(ORDER_ITEMS)))


def build_payment_feed(payments: DataFrame, events: DataFrame, orders: DataFrame) -> DataFrame:
    """c (pending) per payment at the time of its order, u per payment event; the
    offset of an event is its place among those of its payment."""
    made = payments.join(orders.select("order_id", "order_date"), "order_id")
    first = made.select(*_message(PAYMENTS, "c", F.col("order_date"), F.lit(0), None, _wrapped(PAYMENTS, payment_state=F.lit("pending"))))
    moved = payments.join(events.select("payment_id", "previous_state", "new_state", "event_timestamp",
                                        F.element_at(F.split("event_id", "-"), -1).alias("seq")), "payment_id")
    later = moved.select(*_message(PAYMENTS, "u", F.col("event_timestamp"), F.col("seq"),
                                   _wrapped(PAYMENTS, payment_state=F.col("previous_state")),
                                   _wrapped(PAYMENTS, payment_state=F.col("new_state"))))
    return first.unionByName(later)


# ---- parse / dead letter ----------------------------------------------------
def _union_name(name: Column) -> Column:
    return name.isin(*UNION_NAMES) | F.contains(name, F.lit("."))


def _only(m: Column) -> Column:
    return F.get(F.map_values(m), F.lit(0))


def _is_wrapper(m: Column) -> Column:
    return F.coalesce((F.size(m) == 1) & _union_name(F.get(F.map_keys(m), F.lit(0))), F.lit(False))


def unwrap_values(row: Column) -> Column:
    """A row with ``{type: value}`` as the value; the usual ones are read as text."""
    start = '{"string":"'

    def value(v: Column) -> Column:
        # an array of one binds the parsed map, so that it is parsed once
        inner = F.get(F.transform(F.array(F.from_json(v, "map<string,string>")), lambda m: F.when(_is_wrapper(m), _only(m)).otherwise(v)), F.lit(0))
        return (F.when(~F.startswith(v, F.lit("{")), v)
                .when(F.rlike(v, F.lit(WRAPPED_TEXT)), F.substring(v, len(start) + 1, F.length(v) - len(start + '"}')))
                .when(F.rlike(v, F.lit(WRAPPED_SCALAR)), F.regexp_replace(v, WRAPPED_SCALAR, "$1$2")).otherwise(inner))
    return F.transform_values(row, lambda _, v: value(v))


def unwrap_row(image: Column) -> Column:
    """An image ``{record name: row}`` becomes the row."""
    return F.when(_is_wrapper(image), F.from_json(_only(image), "map<string,string>")).otherwise(image)


def unwrap(image: Column) -> Column:
    """An image without its union wrappers: ``{record name: row}`` becomes the
    row, ``{type: value}`` the value.  Plain images stay as they are."""
    return unwrap_values(unwrap_row(image))


def typed(image: Column, name: str, t: T.DataType) -> Column:
    """One column of an image in its type; NULL where the text doesn't fit it."""
    text = F.try_element_at(image, F.lit(name))
    return F.try_to_timestamp(text, F.lit(ISO)) if isinstance(t, T.TimestampType) else text.try_cast(t)


def parse_envelope(feed: DataFrame, table: Captured = ORDERS) -> DataFrame:
    """All messages of a table's topic with their parsed envelope, images without
    wrappers, and a routing verdict; a value that doesn't fit its column is a
    reason for the dead letters too."""
    def parsed(schema: str) -> Column:
        return F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})

    def message(e: Column, before: Column, after: Column) -> Column:
        rest = F.when(e.isNotNull(), F.struct(*[e[c].alias(c) for c in ("op", "ts_ms", "source", "_corrupt")]))
        return F.struct(rest.alias("e"), unwrap_values(before).alias("before_image"), unwrap_values(after).alias("after_image"))

    def general() -> Column:
        return F.get(F.transform(F.array(parsed(ENVELOPE)), lambda e: message(e, unwrap_row(e["before"]), unwrap_row(e["after"]))), F.lit(0))

    def fits(n: Column) -> Column:
        return F.coalesce(n["_corrupt"].isNull() & (n["before"].isNull() | _is_wrapper(n["before"])) & (n["after"].isNull() | _is_wrapper(n["after"])), F.lit(False))

    # rows under record names are parsed in one go; what doesn't fit that form goes the general way.
    # Arrays of one bind what is parsed, and ``inline`` computes its columns once for each row: a filter
    # on the verdict can't be pushed below it, where every mention of an image would parse the message again
    named = F.when(F.rlike(F.substring("value", 1, START), F.lit(NAMED_START)), parsed(NAMED_ENVELOPE))
    p = feed.select("*", F.inline(F.transform(F.array(named), lambda n: F.when(
        n.isNotNull() & fits(n), message(n, _only(n["before"]), _only(n["after"]))).otherwise(general()))))
    after = F.col("after_image")
    # any text fits a column of text
    misfit = reduce(or_, [F.try_element_at(after, F.lit(f.name)).isNotNull() & typed(after, f.name, f.dataType).isNull()
                          for f in table.schema.fields if not isinstance(f.dataType, T.StringType)], F.lit(False))
    tomb = F.col("value").isNull()
    reason = (F.when(tomb, F.lit(None))
              .when(F.col("e").isNull() | F.col("e._corrupt").isNotNull(), "malformed_json")
              .when(~F.coalesce(F.col("e.op").isin(*OPS), F.lit(False)), "unknown_op")
              .when(misfit, "bad_value"))
    return p.withColumn("is_tombstone", tomb).withColumn("dead_reason", reason)


def good_changes(parsed: DataFrame, table: Captured = ORDERS) -> DataFrame:
    g = parsed.filter(F.col("dead_reason").isNull())
    before, after = (lambda c: F.try_element_at("before_image", F.lit(c))), (lambda c: F.try_element_at("after_image", F.lit(c)))
    return g.select(
        "topic", "kafka_offset", "kafka_timestamp", "key", "is_tombstone",
        F.col("e.op").alias("op"), F.col("e.ts_ms").alias("ts_ms"),
        F.coalesce(after("order_id"), before("order_id"), F.col("key")).alias("order_id"),
        F.coalesce(after(table.key), before(table.key), F.col("key")).alias("record_key"),
        F.col("e.source.table").alias("table_name"),
        before("order_state").alias("before_state"), after("order_state").alias("after_state"),
        after("customer_id").alias("after_customer_id"), "before_image", "after_image",
        typed(F.col("after_image"), "total_amount", schemas.MONEY).alias("after_total_amount"),
        typed(F.col("after_image"), "updated_at", T.TimestampType()).alias("after_updated_at"))


def sink_columns(parsed: DataFrame, table: Captured = ORDERS) -> DataFrame:
    """Of parsed messages, what the three sinks read: the image after the change,
    the changed fields of an update, and the message itself only where it is a
    dead letter (so a batch that is kept holds one image of a message)."""
    good = F.col("dead_reason").isNull()
    key = F.coalesce(F.try_element_at("after_image", F.lit(table.key)), F.try_element_at("before_image", F.lit(table.key)), F.col("key"))
    return parsed.select("topic", "kafka_offset", "key", F.when(~good, F.col("value")).alias("value"), "e.op", "e.ts_ms",
                         F.col("e.source.table").alias("table_name"), key.alias("record_key"), "after_image", "is_tombstone", "dead_reason",
                         F.when(good & (F.col("e.op") == "u"), changed("before_image", "after_image")).alias("changed"))


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("dead_reason").isNotNull()).select(
        "topic", "kafka_offset", F.col("dead_reason").alias("reason"), F.col("value").alias("raw_value"))


CHANGED = "array<struct<field:string,old_value:string,new_value:string>>"


def changed(before: str, after: str) -> Column:
    """The columns in which two images differ, with both values; NULL where an image is."""
    def differ(values: Column) -> Column:
        return F.filter(values.cast(CHANGED), lambda c: ~c["old_value"].eqNullSafe(c["new_value"]))

    names = F.array_distinct(F.concat(F.map_keys(before), F.map_keys(after)))
    found = F.transform(names, lambda n: F.struct(n.alias("field"), F.try_element_at(before, n).alias("old_value"), F.try_element_at(after, n).alias("new_value")))
    # images with the same columns in the same order, each once, are compared place by place, without looking names up
    alike = (F.map_keys(before) == F.map_keys(after)) & (F.size(names) == F.size(before))
    return F.when(alike, differ(F.arrays_zip(F.map_keys(before), F.map_values(before), F.map_values(after)))).otherwise(differ(found))


RECORD = ["topic", "kafka_offset", "table_name", "op", "record_key"]


def field_diff(changes: DataFrame) -> DataFrame:
    """The change record of every update: table, op, the table's own key, and one
    row per changed column with its old and new value, whatever columns the
    images have (nothing when an image is NULL)."""
    u = changes.filter((F.col("op") == "u") & F.col("before_image").isNotNull() & F.col("after_image").isNotNull())
    return u.select(*RECORD, F.inline(changed("before_image", "after_image")))


def change_log(kept: DataFrame) -> DataFrame:
    """``field_diff`` of what ``sink_columns`` gives."""
    return kept.filter(F.col("changed").isNotNull()).select(*RECORD, F.inline("changed"))


DEAD = T.StructType([T.StructField("topic", T.StringType()), T.StructField("kafka_offset", T.LongType()),
                     T.StructField("reason", T.StringType()), T.StructField("raw_value", T.StringType())])
CHANGES = T.StructType([T.StructField(c, T.LongType() if c == "kafka_offset" else T.StringType()) for c in (
    "topic", "kafka_offset", "table_name", "op", "record_key", "field", "old_value", "new_value")])


# ---- merge --------------------------------------------------------------------
def latest_images(changes: DataFrame, loaded_at, table: Captured = ORDERS) -> DataFrame:
    """The latest c/u/r image per key (a partial aggregate), typed; ``d`` is logged, not applied."""
    up = changes.filter(F.col("op").isin("c", "u", "r") & ~F.col("is_tombstone"))
    key = F.coalesce(F.try_element_at("after_image", F.lit(table.key)), F.col("key"))
    newest = up.groupBy(key.alias("__key")).agg(F.max_by(
        F.struct("after_image", "ts_ms", "kafka_offset"), F.struct("ts_ms", "kafka_offset")).alias("l"))
    return newest.select(
        F.col("__key").alias(table.key),
        *[typed(F.col("l.after_image"), f.name, f.dataType).alias(f.name) for f in table.schema.fields if f.name != table.key],
        F.col("l.ts_ms").alias("_cdc_ts_ms"), F.col("l.kafka_offset").alias("_cdc_offset"),
        F.lit(loaded_at).cast("timestamp").alias("_cdc_loaded_at"))


def image_schema(table: Captured) -> T.StructType:
    """What ``latest_images`` gives."""
    rest = [f for f in table.schema.fields if f.name != table.key]
    return T.StructType([T.StructField(table.key, T.StringType()), *[T.StructField(f.name, f.dataType) for f in rest],
                         T.StructField("_cdc_ts_ms", T.LongType()), T.StructField("_cdc_offset", T.LongType()),
                         T.StructField("_cdc_loaded_at", T.TimestampType())])


def merge_images(target: DataFrame | None, images: DataFrame, key: str = "order_id") -> DataFrame:
    """One row per key, the one of the newest event; of equal ones the first that
    was loaded stays, so a replayed batch changes nothing."""
    both = images if target is None else target.unionByName(images)
    rest = F.struct(*[c for c in images.columns if c != key])
    newest = F.struct("_cdc_ts_ms", "_cdc_offset", -F.unix_micros("_cdc_loaded_at"))
    return both.groupBy(key).agg(F.max_by(rest, newest).alias("l")).select(key, "l.*")


def merge_batch(target: DataFrame | None, changes: DataFrame, loaded_at=None) -> DataFrame:
    """Upsert a batch of changes (``latest_images`` then ``merge_images``)."""
    return merge_images(target, latest_images(changes, loaded_at))


def reconcile(target: DataFrame, latest_events: DataFrame) -> DataFrame:
    """State in the merged table vs the last state of the event log (NULL-safe);
    an order without events is still as it was placed and isn't compared."""
    t = target.select("order_id", F.col("order_state").alias("cdc_state"))
    o = latest_events.select("order_id", F.col("latest_state").alias("logged_state"))
    j = o.join(t, "order_id", "full_outer")
    issue = (F.when(F.col("cdc_state").isNull(), "missing_in_cdc")
             .when(F.col("logged_state").isNull() & (F.col("cdc_state") != "placed"), "missing_in_log")
             .when(F.col("cdc_state") != F.col("logged_state"), "state_mismatch"))
    return j.select("order_id", "cdc_state", "logged_state", issue.alias("issue")).filter(F.col("issue").isNotNull())


def frame_wire(feed: DataFrame) -> DataFrame:
    """Schema-registry wire format: magic byte 0, 4-byte big-endian schema id, payload."""
    sid = F.lit(None).cast("int")
    for topic, i in SCHEMA_IDS.items():
        sid = F.when(F.col("topic") == topic, F.lit(i)).otherwise(sid)
    framed = F.concat(F.unhex(F.lit("00")), F.unhex(F.lpad(F.hex(sid), 8, "0")), F.encode("value", "UTF-8"))
    return feed.filter(F.col("value").isNotNull()).withColumn("framed", framed)


def parse_wire(framed: DataFrame) -> DataFrame:
    b = F.col("framed")
    return framed.select(
        "kafka_offset",
        F.conv(F.hex(F.substring(b, 1, 1)), 16, 10).cast("int").alias("magic_byte"),
        F.conv(F.hex(F.substring(b, 2, 4)), 16, 10).cast("int").alias("schema_id"),
        (F.decode(F.expr("substring(framed, 6)"), "UTF-8") == F.col("value")).alias("payload_ok"))
