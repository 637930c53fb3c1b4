"""Entity graph, schema ids, sketches, inferred types, named materialisations."""
import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.plans import materialize
from quayside.plans.analytics import Analytics, sketch_error
from quayside.plans.semantic import SemanticLayer, join_path
from quayside.plans.warehouse import Warehouse
from quayside.sources import files
from quayside.streaming import registry

SF = "/root/testdata/sf0.001"


def test_paths_follow_keys_and_never_multiply():
    assert [(a.name, e, b.name) for a, e, b in join_path("order_items", "customer")] == [
        ("order_items", "order", "orders"), ("orders", "customer", "customers")]
    assert join_path("orders", "order") == []
    for entity in ("product", "order_item", "nobody"):
        with pytest.raises(ValueError, match="can't be reached|unknown entity"):
            join_path("orders", entity)


def test_metrics_over_the_graph(spark):
    w = Warehouse(spark, SF)
    layer = SemanticLayer(w)
    with pytest.raises(ValueError, match="without multiplying"):
        layer.query(["revenue"], ["product__price_band"])
    total = w.stg_order_items.agg(F.sum("line_total")).first()[0]
    for by in ([], ["product__price_band"], ["customer__customer_segment", "order__order_state"], ["metric_time__year"]):
        assert layer.query(["item_revenue"], by).agg(F.sum("item_revenue")).first()[0] == total
    both = layer.query(["item_revenue", "order_count"], ["order__payment_method"])
    assert both.agg(F.sum("order_count")).first()[0] == w.fct_orders.count()


SCHEMAS = [(1, "t", 1, "id string not null, n int"), (2, "t", 2, "id string not null, n bigint, extra string"),
           (3, "t", 0, "id string not null, n string"), (4, "u", 1, "id string")]


def _decoded(spark, messages):
    known = registry.load(spark.createDataFrame(SCHEMAS, "schema_id int, subject string, version int, schema string"))
    sent = spark.createDataFrame(messages, "at int, id int, payload string")
    feed = sent.select("at", F.when(F.col("payload").isNotNull(), registry.frame(F.col("id"), F.col("payload"))).alias("framed"))
    rows, dead = registry.decode(feed, known, "t")
    return {r.at: (r.schema_id, r.id, r.n, r.extra) for r in rows.collect()}, {r.at: r.reason for r in dead.collect()}


def test_messages_are_read_by_their_own_schema(spark):
    rows, dead = _decoded(spark, [
        (1, 1, '{"id": "a", "n": 5}'), (2, 2, '{"id": "b", "n": 5000000000, "extra": "x"}'), (3, 1, '{"id": "c"}'),
        (4, 3, '{"id": "d", "n": "q"}'), (5, 77, "{}"), (6, 1, '{"id": "e", "n": '), (7, 1, '{"n": 1}'), (8, 1, '{"id": "f", "n": 5000000000}'),
        (9, 4, '{"id": "g"}'), (10, 1, None), (11, 2, "")])
    assert rows == {1: (1, "a", 5, None), 2: (2, "b", 5_000_000_000, "x"), 3: (1, "c", None, None)}
    assert dead == {4: "incompatible_schema", 5: "unknown_schema", 6: "bad_payload", 7: "bad_payload", 8: "bad_payload",
                    9: "unknown_schema", 11: "bad_payload"}


def test_frames_that_are_none(spark):
    feed = spark.createDataFrame([(1, b"\x01\x00\x00\x00\x01{}"), (2, b"\x00\x00"), (3, b""), (4, None)], "at int, framed binary")
    known = registry.load(spark.createDataFrame(SCHEMAS, "schema_id int, subject string, version int, schema string"))
    rows, dead = registry.decode(feed, known, "t")
    assert rows.count() == 0 and {r.at: r.reason for r in dead.collect()} == {1: "bad_frame", 2: "bad_frame", 3: "bad_frame"}
    with pytest.raises(ValueError, match="no schema"):
        registry.decode(feed, known, "nobody")


def test_what_is_compatible():
    ddl = T._parse_datatype_string
    reader = ddl("id string not null, n bigint")
    assert registry.incompatible(ddl("id string not null, n int"), reader) == []
    assert registry.incompatible(ddl("id string not null"), reader) == []
    assert registry.incompatible(ddl("n int"), reader) == ["added id, which may not be NULL"]
    assert registry.incompatible(ddl("id string, n int, gone int"), reader) == ["dropped gone", "id may no longer be NULL"]
    assert registry.incompatible(ddl("id string not null, n double"), reader) == ["retyped n: double to bigint"]


def test_sketches_merge_to_the_exact_count_within_their_error(spark):
    class Orders:
        stg_orders = spark.range(60_000).select(
            (F.col("id") % 9_000).cast("string").alias("customer_id"),
            F.timestamp_add("DAY", (F.col("id") % 60).cast("int"), F.lit(dt.datetime(2024, 1, 1))).alias("order_date"))
    a = Analytics(Orders)
    daily = a.customer_sketches()
    assert daily.count() == 60
    for grain in ("month", "year"):
        pairs = a.distinct_exact(grain).join(a.distinct_of(daily, grain), grain).collect()
        assert pairs and all(abs(r.estimated_customers - r.exact_customers) <= 4 * sketch_error() * r.exact_customers for r in pairs)


def test_inferred_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b,c,d,e,f,g\n1,3000000000,1.5,true,2024-01-01,x,\n,2,NULL,false,2024-02-01 10:00:00,1,null\n")
    (tmp_path / "b.csv").write_text("a,b,c,d,e,f,g\n7,1,2,null,2024-03-01,2,\n")
    got = files.read_csv_inferred(spark, f"file://{tmp_path}")
    assert dict(got.dtypes) == {"a": "int", "b": "bigint", "c": "double", "d": "boolean", "e": "timestamp", "f": "string", "g": "string"}
    assert sorted(r.a or 0 for r in got.collect()) == [0, 1, 7]


def test_csv_files_are_read_by_line(spark, tmp_path):
    path, schema = f"file://{tmp_path}/x", T._parse_datatype_string("a string")
    files.write_csv(spark.range(20_000).selectExpr("concat('value ', id) AS a").coalesce(1), path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        assert files.read_csv(spark, path, schema).rdd.getNumPartitions() > 1
        assert files.read_csv(spark, path, schema).distinct().count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    with pytest.raises(Exception, match="line break"):
        files.write_csv(spark.createDataFrame([("a\nb",)], schema), path)


def test_pivot_has_every_year(spark):
    class Orders:
        stg_orders = spark.createDataFrame([(dt.datetime(y, 6, 1),) for y in (1995, 1995, 2005, 2031)], "order_date timestamp")
    got = Analytics(Orders).orders_yoy_pivot()
    assert {"1992", "1995", "2005", "2031"} <= set(got.columns)
    assert got.agg(F.sum("1995"), F.sum("2005"), F.sum("2031")).first() == (2, 1, 1)


def test_models_in_order_layers_and_circles():
    order = [n.name for n in materialize.in_order()]
    assert all(order.index(r) < order.index(n.name) for n in materialize.NODES.values() for r in n.refs)
    circle = {n: materialize.Node(n, "marts", (r,)) for n, r in (("a", "b"), ("b", "a"))}
    with pytest.raises(ValueError, match="refer to each other"):
        materialize.in_order(circle)
    with pytest.raises(ValueError, match="isn't a model"):
        materialize.in_order({"a": materialize.Node("a", "marts", ("zz",))})
    assert materialize.database_of("scratch", "dev") == "dev" and materialize.database_of("marts", "dev") == "marts"
