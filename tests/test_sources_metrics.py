"""File loaders, the metric API and incremental runs."""
import decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.catalog import stateful_queries as runs
from quayside.operators import upsert as upserts
from quayside.plans.semantic import SemanticLayer, publish_views
from quayside.plans.warehouse import Warehouse
from quayside.sources import files

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType([T.StructField("sku", T.StringType()), T.StructField("price", T.DecimalType(12, 2)),
                       T.StructField("cost_price", T.DecimalType(12, 2))])


def test_csv_by_header_name(spark, tmp_path):
    (tmp_path / "p.csv").write_text('cost_price,extra,price,sku\n5,x,10,"a ""b""\nline two"\nNULL,y,,null\n')
    got = files.read_csv(spark, f"file://{tmp_path}/p.csv", SCHEMA, multi_line=True).collect()
    assert [tuple(r) for r in got] == [('a "b"\nline two', decimal.Decimal("10.00"), decimal.Decimal("5.00")), (None, None, None)]
    (tmp_path / "q.csv").write_text("sku,price\na,1\n")
    with pytest.raises(ValueError, match="cost_price"):
        files.read_csv(spark, f"file://{tmp_path}/q.csv", SCHEMA)


def test_every_order_is_kept(spark):
    w = Warehouse(spark, SF)
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    assert w.stg_orders.count() == orders.count()
    assert w.stg_orders.join(w.stg_customers, "customer_id", "left_anti").count() == 0
    segments = {r[0] for r in w.dim_customers.select("customer_segment").distinct().collect()}
    assert {"never_ordered", "repeat"} <= segments


def test_metric_api(spark):
    w = Warehouse(spark, SF)
    layer = SemanticLayer(w)
    with pytest.raises(ValueError, match="metric_time"):
        layer.query(["revenue_wow"], ["order__payment_method"])
    total = layer.query(["revenue"]).first()[0]
    cards = layer.query(["revenue"], where="payment_method = 'paypal'").first()[0]
    assert 0 < cards < total
    assert cards == w.fct_orders.filter("payment_method = 'paypal'").agg(F.sum("total_amount")).first()[0]
    by = layer.query(["cumulative_revenue"], ["metric_time__day", "order__order_state"])
    last = by.groupBy("order__order_state").agg(F.max_by("cumulative_revenue", "metric_time__day").alias("v"))
    assert last.agg(F.sum("v")).first()[0] == total
    assert publish_views(w) and spark.table("weekly_revenue_by_segment").agg(F.sum("revenue")).first()[0] == total


def test_metrics_read_the_stored_fact(spark):
    plan = SemanticLayer(Warehouse(spark, SF)).query(["order_count"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Join" not in plan


@pytest.mark.parametrize("name,key", [("fct_orders", "order_id"), ("fct_payments", "payment_id"), ("fct_returns", "order_id")])
def test_incremental_replaces_changed_rows(spark, monkeypatch, name, key):
    """The run that keeps old rows must differ, so the equality below says something."""
    build = getattr(runs, f"incremental_{name}")
    want = sorted(map(repr, getattr(Warehouse(spark, SF), name).collect()))
    cols = getattr(Warehouse(spark, SF), name).columns
    assert sorted(map(repr, build(spark, SF).select(*cols).collect())) == want
    monkeypatch.setattr(upserts, "upsert", lambda target, delta, keys: target.unionByName(
        delta.join(target.select(*keys), keys, "left_anti")))
    kept = sorted(map(repr, build(spark, SF).select(*cols).collect()))
    assert kept != want or name == "fct_returns"
