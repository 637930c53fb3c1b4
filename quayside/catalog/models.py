"""Registered queries: staging, intermediate and mart models."""

from __future__ import annotations

from quayside.oracle import models_sql  # noqa: F401  (registers model CTEs)
from quayside.oracle.ctes import with_ctes
from quayside.plans.warehouse import Warehouse
from quayside.registry import register


def _model(key: str, attr: str | None = None, cte_name: str | None = None):
    attr = attr or key
    cte_name = cte_name or key

    def build(spark, sf_dir):
        w = Warehouse(spark, sf_dir)
        v = getattr(w, attr)
        return v() if callable(v) else v

    register(key, with_ctes(f"SELECT * FROM {cte_name}", cte_name))(build)


for _t in ("addresses", "customers", "products", "orders", "order_items", "payments",
           "order_events", "payment_events"):
    _model(f"stg_{_t}")

for _m in ("int_orders_enriched", "int_orders_with_payments", "int_shipment_timeliness",
           "int_customer_orders", "dim_customers", "dim_products", "fct_orders", "fct_payments",
           "fct_returns", "time_spine", "dim_date"):
    _model(_m)
