"""Registered load/export round trips over data Spark derives from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.oracle import models_sql  # noqa: F401
from quayside.oracle.ctes import with_ctes
from quayside.plans.warehouse import Warehouse
from quayside.registry import register
from quayside.session import scratch_path
from quayside.sources import files
from quayside.sources import schemas as S


@register("load_csv_nulls", with_ctes("""
SELECT customer_id,
       CASE WHEN CAST(customer_id AS BIGINT) % 11 = 0 THEN first_name || ', "Jr"' ELSE first_name END AS first_name,
       CASE WHEN CAST(customer_id AS BIGINT) % 7 IN (0, 1, 2) THEN NULL ELSE last_name END AS last_name,
       email, address_id, created_at
FROM stg_customers""", "stg_customers"))
def load_csv_nulls(spark, sf_dir):
    """Export customers as CSV with the three NULL tokens and quoted commas /
    quotes planted, then load it back with the declared schema."""
    c = Warehouse(spark, sf_dir).stg_customers
    k = F.col("customer_id").cast("long")
    tokens = (F.when(k % 7 == 0, F.lit("")).when(k % 7 == 1, F.lit("NULL")).when(k % 7 == 2, F.lit("null"))
              .otherwise(F.col("last_name")))
    planted = (c.withColumn("last_name", tokens)
               .withColumn("first_name", F.when(k % 11 == 0, F.concat(F.col("first_name"), F.lit(', "Jr"')))
                           .otherwise(F.col("first_name"))))
    path = scratch_path(spark, "customers-csv")
    files.write_csv(planted.select(*reversed(planted.columns)), path)     # the header says which column is which
    return files.read_csv(spark, path, S.CUSTOMERS)


@register("load_parquet_typed", with_ctes("SELECT * FROM stg_orders", "stg_orders"))
def load_parquet_typed(spark, sf_dir):
    """Orders exported with loose types (money as double, times as text) and
    loaded back by casting each column to the warehouse DDL."""
    o = Warehouse(spark, sf_dir).stg_orders
    loose = o.select([F.col(c).cast("double").alias(c) if t.startswith("decimal")
                      else F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if t == "timestamp"
                      else F.col(c) for c, t in o.dtypes])
    path = scratch_path(spark, "orders-export")
    loose.write.mode("overwrite").parquet(path)
    declared = S.T.StructType([f for f in S.ORDERS.fields if f.name in S.WAREHOUSE_ORDER_COLUMNS])
    return files.read_parquet_typed(spark, path, declared)


@register("load_hive_partitions", with_ctes("SELECT * FROM stg_order_events", "stg_order_events"))
def load_hive_partitions(spark, sf_dir):
    """Order events exported as year=/month= partitions and bulk-loaded back
    (partition columns are folder names, not table columns)."""
    e = Warehouse(spark, sf_dir).stg_order_events
    path = scratch_path(spark, "order-events-hive")
    files.write_partitioned(e, path, "event_timestamp")
    return files.read_partitioned(spark, path)


@register("load_csv_inferred", with_ctes("""
SELECT CAST(product_id AS INTEGER) AS product_id, sku, product_name, product_category,
       CAST(unit_price AS DOUBLE) AS unit_price, CASE WHEN CAST(product_id AS BIGINT) % 5 = 0 THEN NULL ELSE CAST(cost_price AS DOUBLE) END AS cost_price,
       DATE '2024-01-01' + CAST(CAST(product_id AS BIGINT) % 300 AS INTEGER) AS listed_on, CAST(product_id AS BIGINT) % 2 = 0 AS is_even
FROM stg_products""", "stg_products"))
def load_csv_inferred(spark, sf_dir):
    """Products exported as CSV with NULL tokens planted, and loaded with types
    found in the values."""
    p = Warehouse(spark, sf_dir).stg_products
    k = F.col("product_id").cast("long")
    listed = F.date_add(F.lit("2024-01-01").cast("date"), (k % 300).cast("int"))
    planted = p.withColumn("cost_price", F.when(k % 5 == 0, F.lit("NULL")).otherwise(F.col("cost_price").cast("string")))
    path = scratch_path(spark, "products-csv")
    files.export(planted.withColumn("listed_on", listed).withColumn("is_even", k % 2 == 0), path, "csv")
    return files.read_csv_inferred(spark, path)


@register("export_by_month", with_ctes("""
SELECT CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month, count(*) AS orders, sum(total_amount) AS revenue
FROM fct_orders GROUP BY 1, 2""", "fct_orders"))
def export_by_month(spark, sf_dir):
    """The order fact exported in month folders; what each folder holds."""
    path = scratch_path(spark, "fct-orders-export")
    files.export(Warehouse(spark, sf_dir).mart("fct_orders"), path, by_month="order_date")
    e = spark.read.parquet(path)
    return e.groupBy("year", "month").agg(F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("revenue"))
