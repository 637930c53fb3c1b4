"""Registered metric queries (semantic layer) and their oracle SQL."""

from __future__ import annotations

from quayside.oracle import models_sql  # noqa: F401
from quayside.oracle.ctes import with_ctes
from quayside.plans.semantic import SemanticLayer, publish_views, saved_query
from quayside.plans.warehouse import Warehouse
from quayside.registry import register


def _metric(key, metrics, group_by, sql, needs=("fct_orders",), **how):
    def build(spark, sf_dir):
        return SemanticLayer(Warehouse(spark, sf_dir)).query(list(metrics), list(group_by), **how)
    register(key, with_ctes(sql, *needs))(build)


def _wk(c):
    return f"CAST(date_trunc('week', {c}) AS DATE)"


def _mo(c):
    return f"CAST(date_trunc('month', {c}) AS DATE)"


_CUST_JOIN = "FROM fct_orders f LEFT JOIN dim_customers c ON f.customer_id = c.customer_id"

_metric("metric_order_count", ["order_count"], ["metric_time__month"], f"""
SELECT {_mo('order_date')} AS metric_time__month, count(order_id) AS order_count FROM fct_orders GROUP BY 1""")

_metric("metric_revenue", ["revenue"], ["metric_time__month"], f"""
SELECT {_mo('order_date')} AS metric_time__month, sum(total_amount) AS revenue FROM fct_orders GROUP BY 1""")

_metric("metric_returned_orders", ["returned_orders"], ["metric_time__month"], f"""
SELECT {_mo('order_date')} AS metric_time__month,
       CAST(sum(CASE WHEN is_returned THEN 1 ELSE 0 END) AS BIGINT) AS returned_orders
FROM fct_orders GROUP BY 1""")

_metric("metric_shipped_revenue", ["shipped_revenue"], ["metric_time__week"], f"""
SELECT {_wk('shipped_at')} AS metric_time__week,
       sum(CASE WHEN order_state = 'delivered' THEN total_amount END) AS shipped_revenue
FROM fct_orders GROUP BY 1""")

_metric("metric_aov", ["average_order_value"], ["customer__customer_segment"], f"""
SELECT c.customer_segment AS customer__customer_segment,
       CAST(sum(f.total_amount) AS DOUBLE) / nullif(CAST(count(f.order_id) AS DOUBLE), 0) AS average_order_value
{_CUST_JOIN} GROUP BY 1""", needs=("fct_orders", "dim_customers"))

_metric("metric_return_rate", ["return_rate"], ["order__payment_method"], """
SELECT payment_method AS order__payment_method,
       CAST(sum(CASE WHEN is_returned THEN 1 ELSE 0 END) AS DOUBLE)
         / nullif(CAST(count(order_id) AS DOUBLE), 0) AS return_rate
FROM fct_orders GROUP BY 1""")

# line items reach their product, their order and, through it, the customer
_metric("metric_item_revenue_by_product", ["item_revenue", "items_sold", "average_item_price"],
        ["product__product_category", "product__price_band"], """
SELECT p.product_category AS product__product_category, p.price_band AS product__price_band,
       sum(i.line_total) AS item_revenue, CAST(sum(i.quantity) AS BIGINT) AS items_sold,
       CAST(sum(i.line_total) AS DOUBLE) / nullif(CAST(sum(i.quantity) AS DOUBLE), 0) AS average_item_price
FROM stg_order_items i LEFT JOIN dim_products p ON p.product_id = i.product_id GROUP BY 1, 2""",
        needs=("stg_order_items", "dim_products"))

_metric("metric_item_revenue_by_segment", ["item_revenue"],
        ["metric_time__quarter", "customer__customer_segment", "product__price_band"], """
SELECT CAST(date_trunc('quarter', o.order_date) AS DATE) AS metric_time__quarter, c.customer_segment AS customer__customer_segment,
       p.price_band AS product__price_band, sum(i.line_total) AS item_revenue
FROM stg_order_items i LEFT JOIN dim_products p ON p.product_id = i.product_id
LEFT JOIN fct_orders o ON o.order_id = i.order_id LEFT JOIN dim_customers c ON c.customer_id = o.customer_id
WHERE o.order_state = 'delivered' GROUP BY 1, 2, 3""",
        needs=("stg_order_items", "dim_products", "fct_orders", "dim_customers"), where="order__order_state = 'delivered'")

_metric("measure_gross_margin", ["gross_margin", "gross_revenue"], ["metric_time__quarter"], """
SELECT CAST(date_trunc('quarter', order_date) AS DATE) AS metric_time__quarter,
       sum(gross_margin) AS gross_margin, sum(gross_revenue) AS gross_revenue
FROM fct_orders GROUP BY 1""")

_metric("measure_cancelled_orders", ["cancelled_orders"], ["customer__state"], f"""
SELECT c.state AS customer__state,
       CAST(sum(CASE WHEN f.is_cancelled THEN 1 ELSE 0 END) AS BIGINT) AS cancelled_orders
{_CUST_JOIN} GROUP BY 1""", needs=("fct_orders", "dim_customers"))

for _grain, _suffix in (("week", ""), ("day", "_daily"), ("month", "_monthly")):
    _metric(f"metric_revenue_wow{_suffix}", ["revenue_wow"], [f"metric_time__{_grain}"], f"""
WITH days AS (SELECT CAST(order_date AS DATE) AS d, sum(total_amount) AS v FROM fct_orders GROUP BY 1),
both_ AS (SELECT date_trunc('{_grain}', d) AS t, v AS now, NULL AS was FROM days
          UNION ALL SELECT date_trunc('{_grain}', d + 7), NULL, v FROM days)
SELECT CAST(t AS DATE) AS metric_time__{_grain},
       CAST(sum(now) - sum(was) AS DOUBLE) / nullif(CAST(sum(was) AS DOUBLE), 0) * 100 AS revenue_wow
FROM both_ GROUP BY t""")

_metric("metric_filtered_revenue", ["revenue", "order_count"], ["metric_time__month"], f"""
SELECT {_mo('f.order_date')} AS metric_time__month, sum(f.total_amount) AS revenue, count(f.order_id) AS order_count
{_CUST_JOIN} WHERE f.payment_method = 'paypal' AND c.customer_segment = 'loyal' GROUP BY 1""",
        needs=("fct_orders", "dim_customers"), where="order__payment_method = 'paypal' AND customer__customer_segment = 'loyal'")

_metric("metric_revenue_by_shipped_month", ["revenue"], ["order__shipped_date__month"], f"""
SELECT {_mo('shipped_at')} AS order__shipped_date__month, sum(total_amount) AS revenue FROM fct_orders GROUP BY 1""")

_metric("metric_cumulative_by_segment", ["cumulative_revenue"], ["metric_time__month", "customer__customer_segment"], """
WITH d AS (SELECT c.customer_segment AS seg, CAST(f.order_date AS DATE) AS day, sum(f.total_amount) AS v
           FROM fct_orders f LEFT JOIN dim_customers c ON f.customer_id = c.customer_id GROUP BY 1, 2),
g AS (SELECT s.date_day, k.seg FROM time_spine s, (SELECT DISTINCT seg FROM d) k),
r AS (SELECT g.seg, g.date_day, sum(coalesce(d.v, 0)) OVER (PARTITION BY g.seg ORDER BY g.date_day) AS run
      FROM g LEFT JOIN d ON d.day = g.date_day AND d.seg IS NOT DISTINCT FROM g.seg)
SELECT CAST(date_trunc('month', date_day) AS DATE) AS metric_time__month, seg AS customer__customer_segment,
       arg_min(run, date_day) AS cumulative_revenue
FROM r GROUP BY 1, 2""", needs=("fct_orders", "dim_customers", "time_spine"))

_metric("metric_cumulative_revenue", ["cumulative_revenue"], ["metric_time__day"], """
SELECT s.date_day AS metric_time__day,
       sum(coalesce(d.v, 0)) OVER (ORDER BY s.date_day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         AS cumulative_revenue
FROM time_spine s
LEFT JOIN (SELECT CAST(order_date AS DATE) AS date_day, sum(total_amount) AS v FROM fct_orders GROUP BY 1) d
  ON s.date_day = d.date_day""", needs=("fct_orders", "time_spine"))


def _saved(key, name, sql, needs=("fct_orders", "dim_customers")):
    register(key, with_ctes(sql, *needs))(lambda spark, sf_dir: saved_query(Warehouse(spark, sf_dir), name))


_saved("metric_weekly_revenue_by_segment", "weekly_revenue_by_segment", f"""
SELECT {_wk('f.order_date')} AS metric_time__week, c.customer_segment AS customer__customer_segment,
       sum(f.total_amount) AS revenue, count(f.order_id) AS order_count
{_CUST_JOIN} GROUP BY 1, 2""")

@register("metric_published_view", with_ctes(f"""
SELECT {_wk('f.order_date')} AS metric_time__week, c.customer_segment AS customer__customer_segment,
       sum(f.total_amount) AS revenue, count(f.order_id) AS order_count
{_CUST_JOIN} GROUP BY 1, 2""", "fct_orders", "dim_customers"))
def metric_published_view(spark, sf_dir):
    publish_views(Warehouse(spark, sf_dir))
    return spark.sql("SELECT * FROM weekly_revenue_by_segment")


_saved("metric_cohort_aov", "customer_cohort_aov", f"""
SELECT c.cohort_month AS customer__cohort_month, c.customer_segment AS customer__customer_segment,
       CAST(sum(f.total_amount) AS DOUBLE) / nullif(CAST(count(f.order_id) AS DOUBLE), 0) AS average_order_value,
       count(f.order_id) AS order_count
{_CUST_JOIN} GROUP BY 1, 2""")

_saved("metric_return_rate_trend", "return_rate_trend", f"""
SELECT {_mo('order_date')} AS metric_time__month,
       CAST(sum(CASE WHEN is_returned THEN 1 ELSE 0 END) AS DOUBLE)
         / nullif(CAST(count(order_id) AS DOUBLE), 0) AS return_rate,
       count(order_id) AS order_count, sum(total_amount) AS revenue
FROM fct_orders GROUP BY 1""", needs=("fct_orders",))


# ---- exposures -------------------------------------------------------------
from quayside.plans import semantic as _sem  # noqa: E402

register("revenue_dashboard", with_ctes("""
SELECT d.week_start_date, count(f.order_id) AS orders, sum(f.total_amount) AS revenue,
       CAST(sum(f.total_amount) AS DOUBLE) / nullif(CAST(count(f.order_id) AS DOUBLE), 0) AS aov,
       CAST(sum(CASE WHEN f.is_returned THEN 1 ELSE 0 END) AS DOUBLE) / nullif(CAST(count(f.order_id) AS DOUBLE), 0) AS return_rate,
       CAST(count(CASE WHEN f.is_on_time THEN 1 END) AS DOUBLE) / nullif(CAST(count(f.is_on_time) AS DOUBLE), 0) AS on_time_share
FROM fct_orders f LEFT JOIN dim_date d ON f.order_date_day = d.date_day
GROUP BY d.week_start_date""", "fct_orders", "dim_date"))(
    lambda spark, sf_dir: _sem.revenue_dashboard(Warehouse(spark, sf_dir)))

register("payment_health", with_ctes("""
SELECT c.customer_segment, count(p.payment_id) AS payments,
       CAST(count(p.authorization_date) AS DOUBLE) / nullif(CAST(count(p.payment_id) AS DOUBLE), 0) AS authorization_rate,
       CAST(sum(p.hours_to_capture) AS DOUBLE) / nullif(CAST(count(p.hours_to_capture) AS DOUBLE), 0) AS avg_hours_to_capture,
       count(CASE WHEN p.is_failed THEN 1 END) AS failures, count(CASE WHEN p.is_refunded THEN 1 END) AS refunds,
       sum(CASE WHEN p.is_refunded THEN p.payment_amount END) AS refunded_amount
FROM fct_payments p LEFT JOIN dim_customers c ON p.customer_id = c.customer_id
GROUP BY c.customer_segment""", "fct_payments", "dim_customers"))(
    lambda spark, sf_dir: _sem.payment_health(Warehouse(spark, sf_dir)))

register("return_rate_by_segment", with_ctes("""
SELECT c.customer_segment AS customer__customer_segment,
       CAST(sum(CASE WHEN f.is_returned THEN 1 ELSE 0 END) AS DOUBLE) / nullif(CAST(count(f.order_id) AS DOUBLE), 0) AS return_rate,
       CAST(sum(CASE WHEN f.is_returned THEN 1 ELSE 0 END) AS BIGINT) AS returned_orders,
       count(f.order_id) AS order_count
FROM fct_orders f LEFT JOIN dim_customers c ON f.customer_id = c.customer_id
GROUP BY 1""", "fct_orders", "dim_customers"))(
    lambda spark, sf_dir: _sem.return_rate_by_segment(Warehouse(spark, sf_dir)))
