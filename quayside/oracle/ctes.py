"""DuckDB SQL for the independent oracle.

Each oracle query is plain ANSI-ish SQL over the driver's pre-registered
views (region, nation, customer, part, orders, lineitem, events, ...).  The
retail tables are CTEs named ``raw_*`` / ``stg_*`` / ``int_*`` ... so they
never shadow the driver's views.  ``with_ctes(body, names)`` prepends the
named CTEs and everything they depend on, in dependency order.
"""

from __future__ import annotations

import re

_CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    _CTES[name] = sql.strip()


def _deps(name: str) -> list[str]:
    sql = _CTES[name]
    return [n for n in _CTES if n != name and re.search(rf"\b{n}\b", sql)]


def with_ctes(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in _deps(n):
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body.strip()
    body = body.strip()
    more = body.startswith("WITH ")          # a body with CTEs of its own continues the list
    return ("WITH " + ",\n".join(f"{n} AS (\n{_CTES[n]}\n)" for n in order) + (",\n" if more else "\n")
            + (body[5:] if more else body))


# --------------------------------------------------------------------------
# Adapter: driver tables -> retail source tables (mirrors sources/adapter.py)
# --------------------------------------------------------------------------
cte("raw_order_core", """
SELECT k, custkey, order_state, order_date, total_amount,
       order_date + INTERVAL (1 + k % 20) HOUR AS confirmed_at,
       CASE WHEN k % 200 <> 7 THEN order_date + INTERVAL (1 + k % 3) DAY END AS shipped_at,
       order_date + INTERVAL (4 + k % 7) DAY AS delivered_at,
       order_date + INTERVAL (12 + k % 20) DAY AS returned_at
FROM (
  SELECT o_orderkey AS k,
         CASE WHEN o_custkey % 20 > 3 OR (o_custkey % 20 > 0 AND o_orderkey % 10 = 0) THEN o_custkey
              WHEN o_custkey <= 3 THEN 4 + o_orderkey % 16
              ELSE (o_custkey // 20) * 20 - 16 + o_orderkey % 16 END AS custkey,
         CASE WHEN o_orderstatus = 'O' THEN
                CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'confirmed'
                     WHEN o_orderpriority = '5-LOW' THEN 'cancelled' ELSE 'placed' END
              WHEN o_orderstatus = 'P' THEN 'shipped'
              ELSE CASE WHEN o_orderpriority = '5-LOW' THEN 'returned' ELSE 'delivered' END
         END AS order_state,
         CAST(o_orderdate AS TIMESTAMP) AS order_date,
         CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount
  FROM orders
) t
""")

cte("raw_orders", """
SELECT CAST(c.k AS VARCHAR) AS order_id,
       CAST(c.custkey AS VARCHAR) AS customer_id,
       c.order_state,
       c.order_date,
       CASE WHEN c.order_state = 'placed' THEN c.order_date
            WHEN c.order_state IN ('confirmed', 'cancelled') THEN c.confirmed_at
            WHEN c.order_state = 'shipped' THEN coalesce(c.shipped_at, c.confirmed_at)
            WHEN c.order_state = 'delivered' THEN c.delivered_at
            ELSE c.returned_at END AS updated_at,
       CAST(coalesce(ls.line_sum, 0) + CASE WHEN c.k % 50 = 0 THEN 1 ELSE 0 END AS DECIMAL(12,2)) AS subtotal,
       CAST(CASE WHEN c.k % 10 = 0 THEN 0 ELSE c.total_amount - coalesce(ls.line_sum, 0) END AS DECIMAL(12,2)) AS tax,
       CAST(0 AS DECIMAL(12,2)) AS shipping_cost,
       c.total_amount,
       CAST(cu.c_nationkey AS VARCHAR) AS shipping_address_id,
       (c.order_state = 'shipped' AND c.k % 100 = 1) AS is_stuck,
       CASE WHEN c.order_state = 'shipped' AND c.k % 100 = 1 THEN 'system_error' END AS stuck_reason,
       c.order_date AS first_event_at
FROM raw_order_core c
LEFT JOIN (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS line_sum
           FROM lineitem GROUP BY l_orderkey) ls ON ls.l_orderkey = c.k
LEFT JOIN customer cu ON cu.c_custkey = c.custkey
""")

cte("raw_order_items", """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_item_id,
       CAST(l_orderkey AS VARCHAR) AS order_id,
       CAST(l_partkey AS VARCHAR) AS product_id,
       CAST(floor(l_quantity) AS INTEGER) AS quantity,
       CAST(floor(l_extendedprice / nullif(l_quantity, 0)) AS DECIMAL(12,2)) AS unit_price,
       CAST(l_extendedprice AS DECIMAL(12,2)) AS total_price
FROM lineitem
""")

cte("raw_products", """
SELECT CAST(p_partkey AS VARCHAR) AS product_id,
       p_brand || '-' || CAST(p_partkey AS VARCHAR) AS sku,
       p_name AS name,
       CAST(p_size * 5 AS DECIMAL(12,2)) AS price,
       CAST(p_size * 3 AS DECIMAL(12,2)) AS cost_price,
       p_type AS category
FROM part
""")

cte("raw_customers", """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
       c_name AS first_name,
       c_mktsegment AS last_name,
       lower(c_name) || '@example.com' AS email,
       CAST(c_nationkey AS VARCHAR) AS address_id,
       CAST(DATE '1995-01-01' + CAST(c_custkey % 700 AS INTEGER) AS TIMESTAMP) AS created_at
FROM customer
""")

cte("raw_addresses", """
SELECT CAST(n_nationkey AS VARCHAR) AS address_id,
       '1 Market Street' AS street_address,
       n_name AS city,
       r_name AS state,
       '00000' AS postal_code,
       'US' AS country
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
""")

cte("raw_payment_core", """
SELECT *,
       CASE WHEN order_state = 'placed' THEN 'pending'
            WHEN order_state = 'confirmed' THEN 'authorized'
            WHEN order_state = 'cancelled' THEN 'failed'
            WHEN order_state = 'returned' THEN CASE WHEN k % 30 = 2 THEN 'captured' ELSE 'refunded' END
            ELSE 'captured' END AS payment_state
FROM raw_order_core
WHERE k % 25 <> 0
""")

cte("raw_payments", """
SELECT 'pay_' || CAST(k AS VARCHAR) AS payment_id,
       CAST(k AS VARCHAR) AS order_id,
       payment_state,
       CAST(total_amount + CASE WHEN k % 40 = 0 THEN 0.05 ELSE 0 END AS DECIMAL(12,2)) AS amount,
       CASE k % 3 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'paypal' ELSE 'debit_card' END AS payment_method,
       order_date + INTERVAL (k % 90) MINUTE AS payment_date,
       CASE WHEN order_state NOT IN ('placed', 'cancelled')
            THEN order_date + INTERVAL (30 + k % 300) MINUTE END AS authorization_date,
       CASE WHEN order_state IN ('shipped', 'delivered', 'returned')
            THEN order_date + INTERVAL (6 + k % 48) HOUR END AS capture_date,
       CASE WHEN payment_state = 'refunded' THEN returned_at END AS refund_date,
       CASE WHEN payment_state = 'failed' THEN 'declined' END AS failure_reason,
       CASE WHEN payment_state <> 'failed' THEN 0 WHEN k % 20 = 3 THEN 4 ELSE 1 END AS retry_count
FROM raw_payment_core
""")

cte("raw_order_events", """
SELECT CAST(k AS VARCHAR) || '-1' AS event_id, CAST(k AS VARCHAR) AS order_id, 'placed' AS previous_state,
       CASE WHEN order_state = 'cancelled' THEN 'cancelled' ELSE 'confirmed' END AS new_state,
       confirmed_at AS event_timestamp, CAST(NULL AS VARCHAR) AS reason, 0 AS retry_count
FROM raw_order_core WHERE order_state <> 'placed'
UNION ALL
SELECT CAST(k AS VARCHAR) || '-2', CAST(k AS VARCHAR), 'confirmed', 'shipped', shipped_at, NULL, 0
FROM raw_order_core WHERE order_state IN ('shipped', 'delivered', 'returned') AND shipped_at IS NOT NULL
UNION ALL
SELECT CAST(k AS VARCHAR) || '-3', CAST(k AS VARCHAR),
       CASE WHEN k % 150 = 11 THEN 'placed' ELSE 'shipped' END, 'delivered', delivered_at, NULL, 0
FROM raw_order_core WHERE order_state IN ('delivered', 'returned')
UNION ALL
SELECT CAST(k AS VARCHAR) || '-4', CAST(k AS VARCHAR), 'delivered', 'returned', returned_at, NULL, 0
FROM raw_order_core WHERE order_state = 'returned'
""")

cte("raw_payment_events", """
SELECT payment_id || '-1' AS event_id, payment_id, CAST(NULL AS VARCHAR) AS previous_state,
       'pending' AS new_state, payment_date AS event_timestamp,
       CAST(NULL AS VARCHAR) AS failure_reason, 0 AS retry_attempt
FROM raw_payments WHERE payment_date IS NOT NULL
UNION ALL
SELECT payment_id || '-2', payment_id, 'pending', 'authorized', authorization_date, NULL, 0
FROM raw_payments WHERE authorization_date IS NOT NULL
UNION ALL
SELECT payment_id || '-3', payment_id, 'authorized', 'captured', capture_date, NULL, 0
FROM raw_payments WHERE capture_date IS NOT NULL
UNION ALL
SELECT payment_id || '-4', payment_id, 'captured', 'refunded', refund_date, NULL, 0
FROM raw_payments WHERE refund_date IS NOT NULL
UNION ALL
SELECT payment_id || '-5', payment_id, 'pending', 'failed', payment_date, 'declined', 1
FROM raw_payments WHERE payment_state = 'failed' AND payment_date IS NOT NULL
UNION ALL
SELECT payment_id || '-6', payment_id, 'failed', 'lost', payment_date, 'unknown', 1
FROM raw_payments WHERE payment_state = 'failed' AND CAST(order_id AS BIGINT) % 37 = 0
""")

# --------------------------------------------------------------------------
# Staging (renames only)
# --------------------------------------------------------------------------
cte("stg_addresses", "SELECT address_id, street_address, city, state, postal_code, country FROM raw_addresses")
cte("stg_customers", "SELECT customer_id, first_name, last_name, email, address_id, created_at FROM raw_customers")
cte("stg_products", """SELECT product_id, sku, name AS product_name, category AS product_category,
       price AS unit_price, cost_price FROM raw_products""")
cte("stg_orders", """SELECT order_id, customer_id, order_state, order_date, updated_at, subtotal, tax,
       shipping_cost, total_amount, shipping_address_id, is_stuck, stuck_reason FROM raw_orders""")
cte("stg_order_items", """SELECT order_item_id, order_id, product_id, quantity, unit_price,
       total_price AS line_total FROM raw_order_items""")
cte("stg_payments", """SELECT payment_id, order_id, payment_state, amount, payment_method, payment_date,
       authorization_date, capture_date, refund_date, failure_reason, retry_count FROM raw_payments""")
cte("stg_order_events", """SELECT event_id, order_id, previous_state, new_state, event_timestamp, reason,
       retry_count FROM raw_order_events""")
cte("stg_payment_events", """SELECT event_id, payment_id, previous_state, new_state, event_timestamp,
       failure_reason, retry_attempt FROM raw_payment_events""")
