"""Staging layer: one projection per source table (renames only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# source table -> list of (source column, staged name)
STAGING = {
    "addresses": ["address_id", "street_address", "city", "state", "postal_code", "country"],
    "customers": ["customer_id", "first_name", "last_name", "email", "address_id", "created_at"],
    "products": ["product_id", "sku", ("name", "product_name"), ("category", "product_category"),
                 ("price", "unit_price"), "cost_price"],
    "orders": ["order_id", "customer_id", "order_state", "order_date", "updated_at", "subtotal", "tax",
               "shipping_cost", "total_amount", "shipping_address_id", "is_stuck", "stuck_reason"],
    "order_items": ["order_item_id", "order_id", "product_id", "quantity", "unit_price",
                    ("total_price", "line_total")],
    "payments": ["payment_id", "order_id", "payment_state", "amount", "payment_method", "payment_date",
                 "authorization_date", "capture_date", "refund_date", "failure_reason", "retry_count"],
    "order_events": ["event_id", "order_id", "previous_state", "new_state", "event_timestamp",
                     "reason", "retry_count"],
    "payment_events": ["event_id", "payment_id", "previous_state", "new_state", "event_timestamp",
                       "failure_reason", "retry_attempt"],
}


def stage(source: DataFrame, table: str) -> DataFrame:
    cols = []
    for c in STAGING[table]:
        src, dst = (c, c) if isinstance(c, str) else c
        cols.append(F.col(src).alias(dst))
    return source.select(cols)
