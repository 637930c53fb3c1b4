import datetime as dt
import json

from pyspark.sql import functions as F

from quayside.streaming import cdc


def _feed(spark, rows):
    return spark.createDataFrame(rows, "topic string, kafka_offset long, kafka_timestamp timestamp, key string, value string")


def _env(op, state, ts_ms, before_state=None):
    img = lambda s: None if s is None else {"order_id": "1", "customer_id": "9", "order_state": s,
                                            "total_amount": 10.5, "updated_at": "2024-01-01T00:00:00Z"}
    return json.dumps({"before": img(before_state), "after": img(state), "op": op, "ts_ms": ts_ms,
                       "source": {"db": "retail", "table": "orders"}})


def test_parse_route_and_replay_safe_merge(spark):
    t = "retail.public.orders"
    rows = [(t, 1, None, "1", _env("c", "placed", 100)),
            (t, 2, None, "1", _env("u", "confirmed", 200, "placed")),
            (t, 3, None, "1", '{"before": null, "aft'),
            (t, 4, None, "1", _env("z", "placed", 300)),
            (t, 5, None, "1", None),
            (t, 6, None, "1", _env("d", None, 400, "confirmed"))]
    parsed = cdc.parse_envelope(_feed(spark, rows))
    dead = {r.kafka_offset: r.reason for r in cdc.dead_letters(parsed).collect()}
    assert dead == {3: "malformed_json", 4: "unknown_op"}
    good = cdc.good_changes(parsed)
    assert sorted(r.kafka_offset for r in good.collect()) == [1, 2, 5, 6]
    diff = cdc.field_diff(good).collect()
    assert [(r.field, r.old_value, r.new_value) for r in diff] == [("order_state", "placed", "confirmed")]
    m1 = cdc.merge_batch(None, good, dt.datetime(2024, 1, 1))
    m2 = cdc.merge_batch(m1, good, dt.datetime(2024, 1, 2))          # replay: nothing changes; delete is a no-op
    assert [(r.order_id, r.customer_id, r.order_state, r._cdc_ts_ms, r._cdc_loaded_at) for r in m2.collect()] == [
        ("1", "9", "confirmed", 200, dt.datetime(2024, 1, 1))]


def test_wrapped_images_and_values_that_do_not_fit(spark):
    t = cdc.PAYMENTS
    image = {"payment_id": "7", "order_id": {"string": "1"}, "payment_state": {"string": "captured"}, "amount": {"double": 10.5},
             "payment_date": {"string": "2024-01-01T00:00:00Z"}, "failure_reason": None, "retry_count": {"int": 2}}

    def env(op, after, ts, before=None):
        return json.dumps({"before": before, "after": after, "op": op, "ts_ms": ts, "source": {"db": "retail", "table": "payments"}})
    rows = [(t.topic, 1, None, "7", env("c", {f"{t.topic}.Value": {**image, "payment_state": {"string": "pending"}}}, 100)),
            (t.topic, 2, None, "7", env("u", {f"{t.topic}.Value": image}, 200, {f"{t.topic}.Value": {**image, "amount": {"double": 9.0}}})),
            (t.topic, 3, None, "7", env("u", {**image, "amount": "ten"}, 300)),
            (t.topic, 4, None, "8", env("c", {"payment_id": "8", "order_id": "2", "failure_reason": "{not json", "retry_count": 0}, 100))]
    parsed = cdc.parse_envelope(_feed(spark, rows), t)
    assert [(r.kafka_offset, r.reason) for r in cdc.dead_letters(parsed).collect()] == [(3, "bad_value")]
    good = cdc.good_changes(parsed)
    assert [(r.field, r.old_value, r.new_value) for r in cdc.field_diff(good).collect()] == [("amount", "9.0", "10.5")]
    got = {r.payment_id: r for r in cdc.latest_images(good, dt.datetime(2024, 1, 1), t).collect()}
    assert (got["7"].payment_state, str(got["7"].amount), got["7"].retry_count, got["7"].failure_reason) == ("captured", "10.50", 2, None)
    assert got["7"].payment_date == dt.datetime(2024, 1, 1) and got["8"].failure_reason == "{not json" and got["8"].amount is None


END = '"op":"u","ts_ms":5,"source":{"db":"d","table":"payments"}}'
NAMED = ['{"before":null,"after":{"r.V":{"a":"1","b":{"string":"x"}}},' + END, '{"after":{"r.V":{"a":1.50,"b":{"int":-0},"c":{"long":7},"d":{"double":2.50}}},' + END,
         '{"after":{"r.V":{"a":"{\\"double\\":1.50}","b":{"string":"{q"},"c":{"string":"t\\\\u"},"d":{"null":null},"e":{"boolean":true}}},' + END,
         '{"after":{"r.V":{"a":{"x.y":"1"},"b":{"z":{"int":1}},"c":[1,{"int":2}],"d":{"string":"x","int":1}}},' + END,
         '{"after":{"r.V":{"a":"1"},"s.V":{"a":"2"}},' + END, '{"after":{"r.V":{"a":"1"}},"before":{"a":"1","b":"2"},' + END,
         '{"after":{"r.V":{"a":"1"}},"before":5,' + END, '{"after":{"r.V":null},' + END, '{"after":{"r.V":{}},"before":{},' + END,
         '{"after":{"r.V":{"a":"1","a":"2"}},' + END, '{"after":{"r.V":{"a":"1"', '{"before":{"r.V":{"a":{"string":"\\t"}}},"after":{"r.V":{"a":{"double":1e3}}},' + END,
         '{"after":{"r.V":{"a":"é","b":{"string":"é\\u00e9"}}},' + END]


def test_rows_under_record_names_are_parsed_in_one_go(spark):
    """Each against the same message with a blank, which goes the general way."""
    slow = [m.replace(":", ": ", 1) for m in NAMED]
    df = spark.createDataFrame([(i, "t", f, s) for i, (f, s) in enumerate(zip(NAMED, slow, strict=True))], "i long, topic string, fast string, slow string")
    got = []
    for c in ("fast", "slow"):
        p = cdc.parse_envelope(df.select("i", "topic", F.col(c).alias("value")), cdc.PAYMENTS)
        # a repeated name can't be collected as a map
        entries = [F.map_entries(c).alias(c) for c in ("before_image", "after_image")]
        got.append([tuple(r) for r in p.select("i", *entries, "e.op", "e.ts_ms", "e.source", "dead_reason").orderBy("i").collect()])
        assert p._jdf.queryExecution().optimizedPlan().toString().count("Generate") == 1
    assert got[0] == got[1]
    assert [tuple(e) for e in got[0][1][2]] == [("a", "1.5"), ("b", "0"), ("c", "7"), ("d", "2.5")]


def test_a_kept_batch_holds_the_changed_fields_instead_of_the_image_before(spark):
    img = lambda **v: json.dumps(v, separators=(",", ":"))
    pairs = [(img(a="1", b="2"), img(a="1", b="3")), (img(a="1", b="2"), img(b="2", a="9")), (img(a="1"), img(a="1", b=None, c="4")),
             (img(b="2", a=None), img(a="1")), ("null", img(a="1")), (img(a="1"), img(a="1")), ('{"a":"1","a":"2"}', '{"a":"1","a":"3"}')]
    rows = [("retail.public.payments", i, None, "k", f'{{"before":{b},"after":{a},"op":"u","ts_ms":{i},"source":{{"db":"d","table":"payments"}}}}')
            for i, (b, a) in enumerate(pairs)]
    parsed = cdc.parse_envelope(_feed(spark, [*rows, ("t", 9, None, "k", "{")]), cdc.PAYMENTS)
    kept = cdc.sink_columns(parsed, cdc.PAYMENTS)
    assert "before_image" not in kept.columns and [(r.kafka_offset, r.raw_value) for r in cdc.dead_letters(kept).collect()] == [(9, "{")]
    log = lambda df: sorted(tuple(r)[1:] for r in df.collect())
    want = [(0, "payments", "u", "k", "b", "2", "3"), (1, "payments", "u", "k", "a", "1", "9"), (2, "payments", "u", "k", "c", None, "4"),
            (3, "payments", "u", "k", "a", None, "1"), (3, "payments", "u", "k", "b", "2", None)]
    assert log(cdc.change_log(kept)) == log(cdc.field_diff(cdc.good_changes(parsed, cdc.PAYMENTS))) == want
    images = [cdc.latest_images(df, dt.datetime(2024, 1, 1), cdc.PAYMENTS).collect() for df in (kept.filter("dead_reason IS NULL"), cdc.good_changes(parsed, cdc.PAYMENTS))]
    assert images[0] == images[1]
