"""Steps that must not run twice, read what nobody asked for, or grow with a file's rows."""
import uuid

from pyspark.sql import functions as F

from quayside import session
from quayside.operators import quality as Q
from quayside.operators.ranking import exact_median, value_counts
from quayside.plans import checks, materialize, warehouse
from quayside.plans.warehouse import Warehouse
from quayside.sources import feed as feed_log
from quayside.sources import loader
from quayside.sources import schemas as S
from quayside.sources.adapter import RetailSource
from quayside.streaming import cdc


def test_only_what_a_model_refers_to_is_loaded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(loader, "_LOADED", {})
    w = Warehouse(spark, "/root/testdata/sf0.001")
    assert not loader._LOADED
    w.stg_products
    assert [list(t) for t in loader._LOADED.values()] == [["products"]]


def test_values_of_a_median_are_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = spark.createDataFrame([(i % 7,) for i in range(100)], "x long").repartition(2).mapInPandas(count, "x long")
    counted = value_counts(df, "x")
    assert exact_median(counted, "x", "m", count="n").first()[0] == 3.0
    assert counted.agg(F.sum("n")).first()[0] == 100 and seen.value == 100
    assert exact_median(spark.createDataFrame([(1,), (2,), (None,)], "x long"), "x", "m").first()[0] == 1.5


def test_orphans_are_counted_by_rows(spark):
    child = spark.createDataFrame([("a",), ("x",), ("x",), (None,), ("y",)], "k string")
    parent = spark.createDataFrame([("a",), ("a",), (None,)], "id string")
    got = Q.relationships(child, "c", "k", parent, "p", "id")
    assert got.first()["failures"] == 3 and got.schema["failures"].dataType.typeName() == "long"
    assert Q.relationships(child.filter("k = 'a'"), "c", "k", parent, "p", "id").first()["failures"] == 0


def test_feed_files_hold_a_bounded_number_of_messages(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(feed_log, "FILE_ROWS", 10)
    feed_log.write_messages(spark.range(45).coalesce(1), f"file://{tmp_path}/in")
    per = spark.read.parquet(f"file://{tmp_path}/in").groupBy(F.input_file_name()).count()
    assert per.agg(F.max("count"), F.sum("count")).first()[:] == (10, 45)


END = '"op":"u","ts_ms":5,"source":{"db":"d","table":"payments"}}'
ODD = [
    '{"before":{"r.V":{"a":"1","b":{"string":"x"}}},"after":{"r.V":{"a":"1","b":{"double":1.50}}},' + END,
    '{"after":{"a":"1","b":{"string":"x:{\\"int\\":5}"}},' + END, '{"after":{"a":"1","b":{"c":{"int":5}}},' + END,
    '{"after":{"a.b":{"a":"1"}},' + END, '{"after":{"a.b":5},' + END, '{"after":{"int":5},' + END, '{"after":{"string":"v"},' + END,
    '{"after":{"a":"x:{","b":"int"},' + END, '{"after":{"a":[{"int":5}],"b":2},' + END, '{"after":{"a":"1","b":{"null":null}},' + END,
    '{"after":{"a":"{\\"int\\":1}","b":"{}"},' + END, '{"after":null,"before":{},' + END, '{"after":5,' + END, '{"after":{"a":1',
    '{"after":{"a":"1","b":"2"},"op":{"string":"u"},"ts_ms":5,"source":{"db":"d","table":"t"}}',
    '{"after":{"a":"1","b":"2"},"op":"u","ts_ms":{"long":5},"source":{"db":{"string":"d"},"table":"t"}}', '{}', "", None, "5"]


def test_messages_unwrapped_as_text_give_what_the_parser_gives(spark):
    """Every message against the same one with a blank, which the fast way passes over."""
    slow = [m and m.replace(':', ': ', 1) if m and m.startswith('{"') else m for m in ODD]
    rows = [(i, "t", f, s) for i, (f, s) in enumerate(zip(ODD, slow, strict=True))]
    df = spark.createDataFrame(rows, "i long, topic string, fast string, slow string")
    got = []
    for c in ("fast", "slow"):
        p = cdc.parse_envelope(df.select("i", "topic", F.col(c).alias("value")), cdc.PAYMENTS)
        got.append({r.i: tuple(r) for r in p.select("i", "before_image", "after_image", "e.op", "e.ts_ms", "e.source", "dead_reason", "is_tombstone").collect()})
    assert got[0] == got[1]
    assert got[0][0][1:3] == ({"a": "1", "b": "x"}, {"a": "1", "b": "1.5"})


def test_keys_are_dealt_before_they_are_counted(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,), (None,)], "k string")
    got = Q.unique(df, "m", "k", 3)
    assert [tuple(r) for r in got.collect()] == [("m", "k", "a", 2)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "ENSURE_REQUIREMENTS" not in plan


def test_joined_models_deal_their_keys_by_the_rows_of_orders(spark, monkeypatch):
    w = Warehouse(spark, "/root/testdata/sf0.001")
    want = {m: sorted(map(tuple, getattr(w, m).collect()), key=repr) for m in checks.DEALT}
    monkeypatch.setattr(warehouse, "TASK_ROWS", 200)
    w = Warehouse(spark, "/root/testdata/sf0.001")
    parts = -(-w.stg_orders.count() // 200)
    assert parts > 4 and checks.Checks(w)._parts("stg_orders") == parts and checks.Checks(w)._parts("time_spine") == 1
    for m in checks.DEALT:
        df = w.enriched_by_order() if m == "int_orders_enriched" else getattr(w, m)
        assert sorted(map(tuple, df.collect()), key=repr) == want[m]
        assert df.rdd.getNumPartitions() == parts


def test_stored_tables_are_written_by_small_tasks(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
             "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    before = [spark.conf.get(k, None) for k in names]
    with session.small_tasks(spark, 1 << 30):
        assert [int(spark.conf.get(k)) for k in names] == [16 << 20, 16 << 20, 256]
    assert [spark.conf.get(k, None) for k in names] == before
    with session.small_tasks(spark, None):
        assert int(spark.conf.get(names[2])) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert session._bytes("134217728b") == session._bytes("128MB") == session._bytes("128m") == 128 << 20


def test_order_joins_carry_only_what_is_used(spark):
    plan = RetailSource(spark, "/root/testdata/sf0.001").orders()._jdf.queryExecution().optimizedPlan().toString()
    joined = plan[plan.index("Join"):]
    assert "delivered_at" not in joined.split("Project", 1)[0] and "updated_at" in joined
    w = Warehouse(spark, "/root/testdata/sf0.001")
    plan = w.order_item_agg._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(order_item_id" in plan[plan.index("Join"):]


def test_models_are_built_from_the_tables_they_refer_to(spark, tmp_path):
    sf, w = "/root/testdata/sf0.001", Warehouse(spark, "/root/testdata/sf0.001")
    catalog = materialize.Catalog(spark, f"t{uuid.uuid4().hex[:8]}")
    first, second = materialize.build(catalog, w), materialize.build(catalog, w)
    assert {r[3] for r in first} == {"built"} and {r[3] for r in second if r[2] == "table"} == {"skipped"}
    for name in materialize.NODES:
        want = w.source(name) if name in S.SOURCE_SCHEMAS else getattr(w, name)
        got = catalog.table(name)
        assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    # what is stored is read, not made again; a loaded source isn't written a second time
    for name, ref in (("fct_orders", "int_orders_enriched"), ("fct_returns", "fct_orders"), ("dim_customers", "customers_scd"), ("dim_products", "products_scd")):
        files = materialize.model(catalog, w, name).inputFiles()
        assert any(f"/{ref}/" in f for f in files) and not any("/order_items/" in f for f in files)
    assert catalog.table("order_items").inputFiles() == w.source("order_items").inputFiles()
    # comments stay with their own model
    own = {(m, c, t) for m, about in materialize.DESCRIPTIONS.items() for c, t in about.items()}
    assert {tuple(r) for r in materialize.descriptions(catalog).collect()} == own
    # a changed source gets a table of its own, and the loaded one stays as it is
    before = w.source("payments").count()
    paid = w.source("payments").limit(5)
    third = {r[0]: r[3:] for r in materialize.build(catalog, Warehouse(spark, sf, sources={"payments": paid}))}
    assert third["payments"] == ("built", 5) and third["fct_returns"][0] == "built" and third["int_orders_enriched"][0] == "skipped"
    assert catalog.table("payments").count() == catalog.table("stg_payments").count() == 5 and w.source("payments").count() == before
