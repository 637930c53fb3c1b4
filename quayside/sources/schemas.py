"""Declared schemas of the eight retail source tables.

Money is DECIMAL(12,2) everywhere (the wider of the source and warehouse
DDL), timestamps are UTC instants, ids are strings.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
S, TS, I, B = T.StringType(), T.TimestampType(), T.IntegerType(), T.BooleanType()


def _schema(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


ADDRESSES = _schema(("address_id", S, False), ("street_address", S, False), ("city", S, False),
                    ("state", S, False), ("postal_code", S, False), ("country", S, False))
CUSTOMERS = _schema(("customer_id", S, False), ("first_name", S, False), ("last_name", S, False),
                    ("email", S, False), ("address_id", S, False), ("created_at", TS, False))
PRODUCTS = _schema(("product_id", S, False), ("sku", S, False), ("name", S, False),
                   ("price", MONEY, False), ("cost_price", MONEY, False), ("category", S, False))
ORDERS = _schema(("order_id", S, False), ("customer_id", S, False), ("order_state", S, False),
                 ("order_date", TS, False), ("updated_at", TS, False), ("subtotal", MONEY, True),
                 ("tax", MONEY, True), ("shipping_cost", MONEY, True), ("total_amount", MONEY, False),
                 ("shipping_address_id", S, False), ("is_stuck", B, True), ("stuck_reason", S, True),
                 ("first_event_at", TS, False))
ORDER_ITEMS = _schema(("order_item_id", S, False), ("order_id", S, False), ("product_id", S, False),
                      ("quantity", I, False), ("unit_price", MONEY, False), ("total_price", MONEY, False))
PAYMENTS = _schema(("payment_id", S, False), ("order_id", S, False), ("payment_state", S, False),
                   ("amount", MONEY, False), ("payment_method", S, False), ("payment_date", TS, True),
                   ("authorization_date", TS, True), ("capture_date", TS, True), ("refund_date", TS, True),
                   ("failure_reason", S, True), ("retry_count", I, False))
ORDER_EVENTS = _schema(("event_id", S, False), ("order_id", S, False), ("previous_state", S, True),
                       ("new_state", S, False), ("event_timestamp", TS, False), ("reason", S, True),
                       ("retry_count", I, True))
PAYMENT_EVENTS = _schema(("event_id", S, False), ("payment_id", S, False), ("previous_state", S, True),
                         ("new_state", S, False), ("event_timestamp", TS, False),
                         ("failure_reason", S, True), ("retry_attempt", I, True))

SOURCE_SCHEMAS = {
    "addresses": ADDRESSES, "customers": CUSTOMERS, "products": PRODUCTS, "orders": ORDERS,
    "order_items": ORDER_ITEMS, "payments": PAYMENTS, "order_events": ORDER_EVENTS,
    "payment_events": PAYMENT_EVENTS,
}

# Columns the warehouse DDL declares for orders; first_event_at exists only
# in the source database (known drift, reported by the schema-drift check).
WAREHOUSE_ORDER_COLUMNS = [f.name for f in ORDERS.fields if f.name != "first_event_at"]

# Lifecycle domains — fixed values of the source state machines.
ORDER_STATES = ("placed", "confirmed", "shipped", "delivered", "returned", "cancelled")
PAYMENT_STATES = ("pending", "authorized", "captured", "refunded", "failed")
PAYMENT_METHODS = ("credit_card", "paypal", "debit_card")
