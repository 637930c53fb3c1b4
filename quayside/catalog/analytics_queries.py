"""Registered exploration analytics and their oracle SQL."""

from __future__ import annotations

from quayside.oracle import models_sql  # noqa: F401
from quayside.oracle.ctes import with_ctes
from quayside.plans import analytics as A
from quayside.plans.analytics import Analytics
from quayside.plans.warehouse import Warehouse
from quayside.registry import register

SQL: dict[str, tuple[str, tuple]] = {}
O, C, I, P = ("stg_orders",), ("stg_customers",), ("stg_order_items",), ("stg_products",)


def _share_sql(table, col, alias):
    return (f"SELECT {col} AS {alias}, count(*) AS n, "
            f"CAST(count(*) AS DOUBLE) * 100 / CAST(sum(count(*)) OVER () AS DOUBLE) AS pct "
            f"FROM {table} GROUP BY {col}")


SQL["customers_daily"] = ("SELECT CAST(created_at AS DATE) AS day, count(*) AS new_customers "
                          "FROM stg_customers GROUP BY 1", C)
SQL["customers_monthly"] = ("SELECT CAST(date_trunc('month', created_at) AS DATE) AS month, "
                            "count(*) AS new_customers FROM stg_customers GROUP BY 1", C)
SQL["customers_running_total"] = ("""
SELECT day, new_customers,
       sum(new_customers) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_customers
FROM (SELECT CAST(created_at AS DATE) AS day, count(*) AS new_customers FROM stg_customers GROUP BY 1) d""", C)
SQL["orders_daily"] = ("SELECT CAST(order_date AS DATE) AS day, count(*) AS orders, sum(total_amount) AS revenue "
                       "FROM stg_orders GROUP BY 1", O)
SQL["orders_monthly_gmv"] = ("""
SELECT month, orders, gmv, CAST(gmv AS DOUBLE) / nullif(CAST(orders AS DOUBLE), 0) AS aov
FROM (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, count(*) AS orders,
             sum(total_amount) AS gmv FROM stg_orders GROUP BY 1) m""", O)
SQL["orders_yoy_weekly"] = ("""
SELECT order_year, week_of_year, count(*) AS orders, DATE '2024-01-01' + (week_of_year - 1) * 7 AS week_anchor
FROM (SELECT CAST(isoyear(order_date) AS INTEGER) AS order_year, CAST(weekofyear(order_date) AS INTEGER) AS week_of_year
      FROM stg_orders) w GROUP BY 1, 2""", O)
SQL["orders_yoy_pivot"] = ("SELECT CAST(weekofyear(order_date) AS INTEGER) AS week_of_year, " + ", ".join(
    f'nullif(count(*) FILTER (isoyear(order_date) = {y}), 0) AS "{y}"' for y in A.PIVOT_YEARS) + " FROM stg_orders GROUP BY 1", O)
SQL["latest_events"] = (f"""
SELECT event_id, order_id, previous_state, new_state, event_timestamp FROM stg_order_events
ORDER BY event_timestamp DESC, event_id DESC LIMIT {A.LATEST_EVENTS}""", ("stg_order_events",))
SQL["december_by_day"] = ("SELECT CAST(day(order_date) AS INTEGER) AS day_of_month, count(*) AS orders "
                          "FROM stg_orders WHERE month(order_date) = 12 GROUP BY 1", O)
SQL["seasonal_lift"] = ("""
SELECT order_year, dec_early, dec_late,
       CAST(dec_late AS DOUBLE) / nullif(CAST(dec_early AS DOUBLE), 0) AS late_early_ratio,
       CAST(dec_orders AS DOUBLE) / nullif(CAST(summer_orders AS DOUBLE) / 5, 0) AS december_lift,
       CAST(jan_orders AS DOUBLE) / nullif(CAST(summer_orders AS DOUBLE) / 5, 0) AS january_ratio
FROM (
  SELECT CAST(year(order_date) AS INTEGER) AS order_year,
         count(*) FILTER (WHERE month(order_date) = 12 AND day(order_date) <= 15) AS dec_early,
         count(*) FILTER (WHERE month(order_date) = 12 AND day(order_date) > 15) AS dec_late,
         count(*) FILTER (WHERE month(order_date) = 12) AS dec_orders,
         count(*) FILTER (WHERE month(order_date) = 1) AS jan_orders,
         count(*) FILTER (WHERE month(order_date) BETWEEN 5 AND 9) AS summer_orders
  FROM stg_orders GROUP BY 1) y""", O)
SQL["category_revenue"] = ("""
SELECT product_category, orders, revenue, lines, CAST(revenue AS DOUBLE) / nullif(CAST(lines AS DOUBLE), 0) AS avg_line_value
FROM (SELECT p.product_category, count(DISTINCT i.order_id) AS orders, sum(i.line_total) AS revenue, count(*) AS lines
      FROM stg_order_items i JOIN stg_products p ON i.product_id = p.product_id GROUP BY 1) g""", I + P)
SQL["order_economics"] = ("""
SELECT count(*) AS total_orders, min(total_amount) AS min_order_value, max(total_amount) AS max_order_value,
       sum(total_amount) AS total_gmv,
       round(avg(CAST(subtotal / total_amount AS DOUBLE) * 100), 6) AS avg_subtotal_pct,
       CAST(sum(total_amount) AS DOUBLE) / nullif(CAST(count(*) AS DOUBLE), 0) AS avg_order_value,
       median(CAST(total_amount AS DOUBLE)) AS median_order_value
FROM stg_orders""", O)
SQL["items_per_order"] = ("""
SELECT CAST(sum(cnt) AS DOUBLE) / nullif(CAST(count(*) AS DOUBLE), 0) AS avg_items_per_order,
       min(cnt) AS min_items, max(cnt) AS max_items, median(CAST(cnt AS DOUBLE)) AS median_items_per_order
FROM (SELECT order_id, count(*) AS cnt FROM stg_order_items GROUP BY order_id) t""", I)
SQL["orders_per_customer"] = (f"""
SELECT least(n, {A.ORDERS_CAP}) AS orders_placed, count(*) AS customers
FROM (SELECT customer_id, count(*) AS n FROM stg_orders GROUP BY customer_id) t GROUP BY 1""", O)
SQL["aov_histogram"] = (f"""
SELECT CAST(floor(total_amount / {A.AOV_BUCKET}) * {A.AOV_BUCKET} AS BIGINT) AS bucket, count(*) AS orders
FROM stg_orders GROUP BY 1""", O)
SQL["customer_activity_rate"] = ("""
SELECT a.customers_with_orders, t.total_customers,
       CAST(a.customers_with_orders AS DOUBLE) * 100 / nullif(CAST(t.total_customers AS DOUBLE), 0) AS pct_active
FROM (SELECT count(DISTINCT customer_id) AS customers_with_orders FROM stg_orders) a,
     (SELECT count(*) AS total_customers FROM stg_customers) t""", O + C)
SQL["order_transitions"] = ("SELECT previous_state || ' → ' || new_state AS transition, count(*) AS events "
                            "FROM stg_order_events GROUP BY 1", ("stg_order_events",))
_CARD_COLS = ["customer_id", "first_name", "last_name", "email", "address_id", "created_at"]
SQL["column_cardinality"] = (" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, count(*) AS n_rows, "
    f"CAST(count(DISTINCT {c}) AS DOUBLE) / nullif(CAST(count(*) AS DOUBLE), 0) AS cardinality FROM stg_customers"
    for c in _CARD_COLS), C)
SQL["order_state_share"] = (_share_sql("stg_orders", "order_state", "order_state"), O)
SQL["payment_state_share"] = (_share_sql("stg_payments", "payment_state", "payment_state"), ("stg_payments",))
SQL["payment_method_share"] = (_share_sql("stg_payments", "payment_method", "payment_method"), ("stg_payments",))
_COUNTS = "SELECT product_id, count(*) AS line_count FROM stg_order_items GROUP BY product_id"
SQL["top_products"] = (f"""
SELECT i.product_id, count(*) AS line_count, sum(i.line_total) AS revenue, any_value(p.product_name) AS product_name,
       any_value(p.product_category) AS product_category
FROM stg_order_items i LEFT JOIN stg_products p ON i.product_id = p.product_id
GROUP BY i.product_id ORDER BY line_count DESC, i.product_id ASC LIMIT {A.TOP_N}""", I + P)
SQL["product_pareto"] = (f"""
SELECT product_id, line_count, product_rank,
       CAST(product_rank AS DOUBLE) / CAST(n_products AS DOUBLE) AS rank_pct,
       CAST(cum_lines AS DOUBLE) / CAST(total_lines AS DOUBLE) AS cum_share,
       CAST(product_rank AS DOUBLE) / CAST(n_products AS DOUBLE) <= 0.2 AS in_top_20pct
FROM (
  SELECT product_id, line_count,
         row_number() OVER (ORDER BY line_count DESC, product_id) AS product_rank,
         sum(line_count) OVER (ORDER BY line_count DESC, product_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_lines,
         count(*) OVER () AS n_products, sum(line_count) OVER () AS total_lines
  FROM ({_COUNTS}) c) r""", I)
SQL["zipf_fit"] = (f"""
SELECT round(regr_slope(log10(CAST(line_count AS DOUBLE)), log10(CAST(product_rank AS DOUBLE))), 9) AS slope, count(*) AS n_products
FROM (SELECT line_count, row_number() OVER (ORDER BY line_count DESC, product_id) AS product_rank FROM ({_COUNTS}) c) r""", I)
SQL["value_frequency"] = (f"""
SELECT last_name AS value, count(*) AS n, CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share
FROM stg_customers GROUP BY last_name ORDER BY n DESC, value ASC LIMIT {A.TOP_VALUES}""", C)
SQL["household_cap"] = (f"SELECT address_id, count(*) AS household_size FROM stg_customers GROUP BY address_id "
                        f"HAVING count(*) > {A.HOUSEHOLD_CAP}", C)
SQL["household_members"] = ("""
SELECT customer_id, address_id, created_at, rn = 1 AS is_primary,
       first_value(customer_id) OVER w AS primary_customer_id, first_value(created_at) OVER w AS primary_created_at
FROM (SELECT *, row_number() OVER (PARTITION BY address_id ORDER BY created_at, customer_id) AS rn FROM stg_customers) c
WINDOW w AS (PARTITION BY address_id ORDER BY created_at, customer_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", C)
SQL["household_order_violations"] = ("""
SELECT o.order_id, o.customer_id, c.address_id, o.order_date, h.household_first_created_at
FROM stg_orders o JOIN stg_customers c ON o.customer_id = c.customer_id
JOIN (SELECT address_id, min(created_at) AS household_first_created_at FROM stg_customers GROUP BY address_id) h
  ON c.address_id = h.address_id
WHERE o.order_date < h.household_first_created_at""", O + C)
SQL["geo_distribution"] = ("""
SELECT coalesce(cs.state, os.state) AS state, coalesce(cs.customer_share, 0.0) AS customer_share,
       coalesce(os.order_share, 0.0) AS order_share,
       coalesce(os.order_share, 0.0) - coalesce(cs.customer_share, 0.0) AS share_diff
FROM (SELECT a.state, CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS customer_share
      FROM stg_customers c JOIN stg_addresses a ON c.address_id = a.address_id GROUP BY a.state) cs
FULL OUTER JOIN (
      SELECT a.state, CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS order_share
      FROM stg_orders o JOIN stg_addresses a ON o.shipping_address_id = a.address_id GROUP BY a.state) os
  ON cs.state = os.state""", O + C + ("stg_addresses",))
_TZ = " ".join(f"WHEN '{r}' THEN '{z}'" for r, z in A.REGION_TZ.items())
SQL["orders_by_local_hour"] = (f"""
SELECT state, CAST(hour(timezone(tz, CAST(order_date AS TIMESTAMPTZ))) AS INTEGER) AS local_hour, count(*) AS orders
FROM (SELECT o.order_date, a.state, CASE a.state {_TZ} ELSE 'UTC' END AS tz
      FROM stg_orders o JOIN stg_customers c ON o.customer_id = c.customer_id
      JOIN stg_addresses a ON c.address_id = a.address_id) t
GROUP BY 1, 2""", O + C + ("stg_addresses",))
SQL["distinct_addresses"] = ("""
SELECT a.address_id, a.city, a.state, a.postal_code, a.country
FROM (SELECT DISTINCT shipping_address_id FROM stg_orders) u JOIN stg_addresses a ON u.shipping_address_id = a.address_id""",
                             O + ("stg_addresses",))
SQL["customers_as_of"] = (f"SELECT * FROM stg_customers WHERE created_at <= TIMESTAMP '{A.CUSTOMERS_AS_OF} 00:00:00'", C)
SQL["latest_order_state"] = ("""
SELECT order_id, new_state AS latest_state, event_timestamp AS latest_event_at
FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY event_timestamp DESC, event_id DESC) AS rn
      FROM stg_order_events) e WHERE rn = 1""", ("stg_order_events",))
_TABLES = ("addresses", "customers", "products", "orders", "order_items", "payments", "order_events", "payment_events")
SQL["row_counts"] = (" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM raw_{t}"
                                        for t in _TABLES) + " ORDER BY table_name", tuple(f"raw_{t}" for t in _TABLES))


def _reg(key):
    body, needs = SQL[key]
    register(key, with_ctes(body, *needs))(
        lambda spark, sf_dir: getattr(Analytics(Warehouse(spark, sf_dir)), key)())


for _k in SQL:
    _reg(_k)
