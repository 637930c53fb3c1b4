"""Registered data-quality queries and their oracle SQL."""

from __future__ import annotations

from quayside.oracle import models_sql  # noqa: F401
from quayside.oracle.ctes import with_ctes
from quayside.plans import checks as C
from quayside.plans.checks import Checks
from quayside.plans.staging import STAGING
from quayside.plans.warehouse import Warehouse
from quayside.registry import register

AS_OF_SQL = f"TIMESTAMP '{C.DQ_AS_OF:%Y-%m-%d %H:%M:%S}'"


def _lit(v):
    return "NULL" if v is None else f"'{v}'"


def _in_list(vals):
    return ", ".join(_lit(v) for v in vals)


SQL: dict[str, tuple[str, tuple]] = {}

SQL["unique"] = (" UNION ALL ".join(
    f"SELECT '{m}' AS model, '{c}' AS column_name, CAST({c} AS VARCHAR) AS key_value, count(*) AS n_rows "
    f"FROM {m} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1" for m, c in C.UNIQUE_TESTS),
    tuple({m for m, _ in C.UNIQUE_TESTS}))

SQL["not_null"] = (" UNION ALL ".join(
    f"SELECT 'stg_{t}' AS model, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS failures "
    f"FROM stg_{t}" for t in STAGING for c in C.not_null_columns(t)),
    tuple(f"stg_{t}" for t in STAGING))

SQL["accepted_values"] = (" UNION ALL ".join(
    f"SELECT '{m}' AS model, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n_rows "
    f"FROM {m} WHERE {c} IS NOT NULL AND {c} NOT IN ({_in_list(v)}) GROUP BY {c}"
    for m, c, v in C.ACCEPTED_TESTS),
    tuple({m for m, _, _ in C.ACCEPTED_TESTS}))

SQL["relationships"] = (" UNION ALL ".join(
    f"SELECT '{m}' AS model, '{c}' AS column_name, '{p}.{pc}' AS parent, count(*) AS failures "
    f"FROM {m} ch WHERE ch.{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} pa WHERE pa.{pc} = ch.{c})"
    for m, c, p, pc in C.RELATIONSHIP_TESTS),
    tuple({m for m, *_ in C.RELATIONSHIP_TESTS} | {p for *_, p, _ in C.RELATIONSHIP_TESTS}))


def _age(col):
    return f"CAST(date_diff('second', {col}, {AS_OF_SQL}) AS DOUBLE) / 3600.0"


SQL["recency"] = (f"""
SELECT 'fct_orders' AS model, 'updated_at' AS column_name, max_value, {_age('max_value')} AS hours_behind,
       CASE WHEN max_value IS NULL OR {_age('max_value')} > {C.RECENCY_HOURS} THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT max(updated_at) AS max_value FROM fct_orders) t""", ("fct_orders",))

SQL["freshness"] = (" UNION ALL ".join(f"""
SELECT '{src}' AS source, m AS max_loaded_at, {_age('m')} AS age_hours,
       CASE WHEN m IS NULL OR {_age('m')} > {err} THEN 'error' WHEN {_age('m')} > {warn} THEN 'warn'
            ELSE 'pass' END AS status
FROM (SELECT max({col}) AS m FROM raw_{src}) t""" for src, (col, warn, err) in C.FRESHNESS.items()),
    tuple(f"raw_{s}" for s in C.FRESHNESS))

SQL["order_totals"] = ("""
WITH lines AS (SELECT order_id, sum(line_total) AS items_subtotal FROM stg_order_items GROUP BY ALL)
SELECT order_id, subtotal AS order_subtotal, items_subtotal, abs(subtotal - items_subtotal) AS delta
FROM lines INNER JOIN stg_orders USING (order_id)
WHERE NOT (subtotal BETWEEN items_subtotal - 0.01 AND items_subtotal + 0.01)""", ("stg_orders", "stg_order_items"))

_INTEGRITY = [
    ("order older than its customer",
     "SELECT order_id FROM stg_orders x WHERE EXISTS (FROM stg_customers y WHERE y.customer_id = x.customer_id "
     "AND y.created_at > x.order_date)"),
    ("event older than its order",
     "SELECT event_id FROM stg_order_events x WHERE EXISTS (FROM stg_orders y WHERE y.order_id = x.order_id "
     "AND y.order_date > x.event_timestamp)"),
    ("order changed before it was placed", "SELECT order_id FROM stg_orders WHERE order_date > updated_at"),
    ("line of an unknown order", "SELECT order_item_id FROM stg_order_items ANTI JOIN stg_orders USING (order_id)"),
    ("payment of an unknown order", "SELECT payment_id FROM stg_payments ANTI JOIN stg_orders USING (order_id)"),
]


def _summary(name, body, count_col=None, severity="fail"):
    n = f"CAST(coalesce(sum({count_col}), 0) AS BIGINT)" if count_col else "count(*)"
    return (f"SELECT '{name}' AS check_name, {n} AS failures, "
            f"CASE WHEN {n} = 0 THEN 'pass' ELSE '{severity}' END AS status FROM ({body}) t")


SQL["integrity"] = (" UNION ALL ".join(_summary(n, b) for n, b in _INTEGRITY),
                    ("stg_orders", "stg_customers", "stg_order_events", "stg_order_items", "stg_payments"))

SQL["refund_le_total"] = ("""
SELECT payment_id, order_id, payment_amount AS refund_amount, order_amount FROM fct_payments
WHERE is_refunded AND payment_amount > order_amount""", ("fct_payments",))

SQL["total_components"] = ("""
SELECT * FROM (
  SELECT o.order_id, o.subtotal, o.tax, o.shipping_cost, o.total_amount, p.amount AS payment_amount,
         coalesce(o.subtotal + o.tax + o.shipping_cost = o.total_amount, false) AS components_ok,
         (p.amount IS NULL OR p.amount = o.total_amount) AS payment_ok
  FROM stg_orders o LEFT JOIN stg_payments p ON o.order_id = p.order_id) t
WHERE NOT components_ok OR NOT payment_ok""", ("stg_orders", "stg_payments"))


def _legal_sql(moves):
    return " OR ".join(
        f"(previous_state {'IS NULL' if a is None else '= ' + _lit(a)} AND new_state = '{b}')" for a, b in moves)


SQL["illegal_transitions"] = (f"""
SELECT 'order' AS log, order_id AS entity_id, event_id, previous_state, new_state, event_timestamp
FROM stg_order_events WHERE NOT coalesce({_legal_sql(C.ORDER_MOVES)}, false)
UNION ALL
SELECT 'payment', payment_id, event_id, previous_state, new_state, event_timestamp
FROM stg_payment_events WHERE NOT coalesce({_legal_sql(C.PAYMENT_MOVES)} OR new_state = 'refunded', false)""",
                              ("stg_order_events", "stg_payment_events"))

SQL["paired_events"] = ("""
SELECT * FROM (
  SELECT o.order_id, p.payment_id, o.order_state, p.payment_state, r.returned_at, p.refund_date,
         CASE WHEN p.payment_id IS NULL THEN 'no_payment'
              WHEN p.payment_state <> 'refunded' THEN 'not_refunded'
              WHEN p.refund_date IS DISTINCT FROM r.returned_at THEN 'timestamp_mismatch' END AS issue
  FROM stg_orders o
  LEFT JOIN (SELECT order_id, max(event_timestamp) AS returned_at FROM stg_order_events
             WHERE new_state = 'returned' GROUP BY order_id) r ON o.order_id = r.order_id
  LEFT JOIN stg_payments p ON o.order_id = p.order_id
  WHERE o.order_state = 'returned') t
WHERE issue IS NOT NULL""", ("stg_orders", "stg_order_events", "stg_payments"))

_MONO = """
SELECT e.order_id, e.event_id, e.previous_state, e.new_state, e.event_timestamp, o.order_date, o.updated_at,
       lag(e.new_state) OVER (PARTITION BY e.order_id ORDER BY e.event_timestamp, e.event_id) AS prev_new,
       max(e.event_timestamp) OVER (PARTITION BY e.order_id) AS last_ts
FROM stg_order_events e LEFT JOIN stg_orders o ON e.order_id = o.order_id"""
SQL["event_monotonic"] = (f"""
SELECT order_id, event_id, previous_state, new_state, event_timestamp, 'before_order' AS issue
FROM ({_MONO}) m WHERE event_timestamp < order_date
UNION ALL
SELECT order_id, event_id, previous_state, new_state, event_timestamp, 'continuity'
FROM ({_MONO}) m WHERE prev_new IS NOT NULL AND previous_state IS DISTINCT FROM prev_new
UNION ALL
SELECT order_id, event_id, previous_state, new_state, event_timestamp, 'no_order'
FROM ({_MONO}) m WHERE event_timestamp IS NOT NULL AND order_date IS NULL
UNION ALL
SELECT order_id, event_id, previous_state, new_state, event_timestamp, 'updated_at_mismatch'
FROM ({_MONO}) m WHERE event_timestamp = last_ts AND updated_at <> last_ts""",
                          ("stg_order_events", "stg_orders"))

SQL["retry_limit"] = (f"""
SELECT * FROM (
  SELECT p.payment_id, p.payment_state, p.retry_count, coalesce(f.failed_moves, 0) AS failed_moves
  FROM stg_payments p
  LEFT JOIN (SELECT payment_id, count(*) AS failed_moves FROM stg_payment_events
             WHERE new_state = 'failed' GROUP BY payment_id) f ON p.payment_id = f.payment_id) t
WHERE retry_count > {C.MAX_RETRIES} OR failed_moves > {C.MAX_RETRIES}
   OR (payment_state = 'failed' AND failed_moves <> retry_count)""", ("stg_payments", "stg_payment_events"))


def _shares(table, col, domain, ranges):
    want = ", ".join(f"('{s}', {float(lo)}::DOUBLE, {float(hi)}::DOUBLE, {incl}, '{miss}')"
                     for s, (lo, hi, incl, miss) in ranges.items())
    return f"""
SELECT '{domain}' AS domain, state, n, pct, lo, hi,
       CASE WHEN (pct > lo OR (incl AND pct = lo)) AND pct <= hi THEN 'pass' ELSE miss END AS status
FROM (
  SELECT v.*, count(t.{col}) AS n,
         coalesce(CAST(count(t.{col}) AS DOUBLE) * 100 / nullif(CAST((SELECT count(*) FROM {table}) AS DOUBLE), 0), 0.0) AS pct
  FROM (VALUES {want}) v(state, lo, hi, incl, miss) LEFT JOIN {table} t ON t.{col} = v.state GROUP BY ALL) s"""


SQL["share_ranges"] = (_shares("stg_orders", "order_state", "order", C.ORDER_STATE_RANGES) + " UNION ALL "
                       + _shares("stg_payments", "payment_state", "payment", C.PAYMENT_STATE_RANGES),
                       ("stg_orders", "stg_payments"))

SQL["row_minimums"] = (" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST({n} AS BIGINT) AS min_expected, "
    f"CASE WHEN count(*) >= {n} THEN 'pass' ELSE 'fail' END AS status FROM raw_{t}"
    for t, n in C.ROW_MINIMUMS.items()), tuple(f"raw_{t}" for t in C.ROW_MINIMUMS))

SQL["orders_without_items"] = ("""
SELECT o.order_id FROM stg_orders o WHERE NOT EXISTS (SELECT 1 FROM stg_order_items i WHERE i.order_id = o.order_id)
""", ("stg_orders", "stg_order_items"))

_SCORE = [
    ("unique", "unique", None, "fail"), ("not_null", "not_null", "failures", "fail"),
    ("accepted_values", "accepted_values", "n_rows", "fail"),
    ("relationships", "relationships", "failures", "fail"),
    ("order_totals_balance", "order_totals", None, "fail"), ("integrity", None, None, None),
    ("refund_le_total", "refund_le_total", None, "fail"), ("total_components", "total_components", None, "fail"),
    ("illegal_transitions", "illegal_transitions", None, "fail"), ("paired_events", "paired_events", None, "fail"),
    ("event_monotonic", "event_monotonic", None, "fail"), ("retry_limit", "retry_limit", None, "fail"),
    ("share_ranges", "share_ranges", None, "fail"), ("row_minimums", "row_minimums", None, "fail"),
    ("orders_without_items", "orders_without_items", None, "warn"),
    ("recency", "recency", None, "warn"), ("freshness", "freshness", None, "warn"),
]


def _score_sql():
    parts, needs = [], set()
    for name, key, col, sev in _SCORE:
        if key is None:
            body, n = SQL["integrity"]
            parts.append(body)
        else:
            body, n = SQL[key]
            if key in ("share_ranges", "row_minimums", "recency", "freshness"):
                body = f"SELECT * FROM ({body}) x WHERE status <> 'pass'"
            parts.append(_summary(name, body, col, sev))
        needs |= set(n)
    return " UNION ALL ".join(parts), tuple(sorted(needs))


SQL["scorecard"] = _score_sql()


def _reg(key):
    body, needs = SQL[key]

    def build(spark, sf_dir):
        return getattr(Checks(Warehouse(spark, sf_dir)), key)()

    register(f"dq_{key}", with_ctes(body, *needs))(build)


for _k in SQL:
    _reg(_k)
