"""Staging -> intermediate -> marts, as lazy DataFrames.

``Warehouse(spark, sf_dir)`` exposes every model as a property.  Nothing
is materialised; each property is a logical plan that Catalyst prunes and
pushes down into the Parquet scans.  Models that feed several consumers
are ordinary DataFrames, so a query touching one model never pays for the
others.

Plan choices (see README "Scale"):
* ``int_orders_enriched`` aggregates line items to order grain *before*
  joining orders (partial + final HashAggregate, one shuffle on order_id).
* ``fct_orders`` joins the enriched orders directly to payments and to the
  per-order transition times.  The reference joins to two order-grain
  intermediates that are themselves ``orders LEFT JOIN x``; because
  ``order_id`` is the orders primary key (checked by ``dq_unique``) that
  is the same relation, and this plan drops two extra scans + shuffles of
  orders.  All three inputs are hash-partitioned on ``order_id``, so the
  chained joins reuse one partitioning.
* event pivots filter to the states they pivot before the shuffle.
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.scalars import (customer_segment, day_of_week_sunday0, days_between,
                                        hours_between, price_band, safe_ratio, trunc_date)
from quayside.operators.scd2 import scd2_apply, scd2_current
from quayside.plans.staging import stage
from quayside.sources.adapter import RetailSource, conform
from quayside.sources.loader import fingerprint, load_source, source_path, stored_mart
from quayside.sources import schemas as S

# Report date for clock-dependent columns (activity flag, freshness):
# passed explicitly so results are reproducible (reference uses the clock).
DEFAULT_AS_OF = _dt.date(2001, 6, 30)
# Snapshot run time of the first SCD2 build feeding the dimensions.
DEFAULT_RUN_TS = _dt.datetime(2024, 1, 1)
SLA_DAYS = 7
#: Rows of a table that a task gets where keys are dealt by the table's size.
TASK_ROWS = 500_000


class Warehouse:
    """All models over one source database.

    ``sources`` overrides individual source tables (tests, incremental runs);
    ``loaded=True`` reads the tables written once by ``load_source``, each when a
    model refers to it, instead of deriving them from the driver tables inside
    every plan.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, as_of=DEFAULT_AS_OF,
                 run_ts=DEFAULT_RUN_TS, sources: dict[str, DataFrame] | None = None,
                 loaded: bool = True):
        self.spark, self.sf_dir = spark, sf_dir
        self.as_of, self.run_ts = as_of, run_ts
        self._src, self._tasks = RetailSource(spark, sf_dir), {}
        self._state = fingerprint(spark, sf_dir) if loaded else None
        self._loaded, self._overrides = loaded, dict(sources or {})
        self._stored = loaded and not sources and as_of == DEFAULT_AS_OF and run_ts == DEFAULT_RUN_TS

    def mart(self, name: str) -> DataFrame:
        """A mart as stored once for this input; with other sources or dates, its plan."""
        if not self._stored:
            return getattr(self, name)
        if name == "fct_returns":       # its orders are those of the stored fact
            return stored_mart(self.spark, self.sf_dir, self._state, name, lambda: self.build_fct_returns(self.mart("fct_orders")))
        return stored_mart(self.spark, self.sf_dir, self._state, name, lambda: getattr(self, name))

    # -- sources & staging ----------------------------------------------
    def source(self, name: str) -> DataFrame:
        if name in self._overrides:
            return self._overrides[name]
        if self._loaded:
            return load_source(self.spark, self.sf_dir, name, self._state)
        return conform(self._src.table(name), S.SOURCE_SCHEMAS[name])

    def stored_at(self, name: str) -> str | None:
        """The folder of a loaded source; None for one that isn't stored."""
        if not self._loaded or name in self._overrides:
            return None
        self.source(name)
        return source_path(self.spark, self.sf_dir, name, self._state)

    @property
    def input_bytes(self) -> int | None:
        return self._state[1] if self._loaded else None

    def stg(self, name: str) -> DataFrame:
        return stage(self.source(name), name)

    def tasks(self, table: str) -> int:
        """Tasks that about ``TASK_ROWS`` rows of a loaded source make (a count reads
        file footers only); 1 for others."""
        if not self._loaded or table in self._overrides:
            return 1
        if table not in self._tasks:
            self._tasks[table] = -(-self.source(table).count() // TASK_ROWS) or 1
        return self._tasks[table]

    def dealt(self, df: DataFrame, key: str, table: str) -> DataFrame:
        """``df`` by ``key``, over as many tasks as ``table`` asks for; small ones as they are."""
        return df.repartition(n, key) if (n := self.tasks(table)) > 1 else df

    stg_addresses = property(lambda self: self.stg("addresses"))
    stg_customers = property(lambda self: self.stg("customers"))
    stg_products = property(lambda self: self.stg("products"))
    stg_orders = property(lambda self: self.stg("orders"))
    stg_order_items = property(lambda self: self.stg("order_items"))
    stg_payments = property(lambda self: self.stg("payments"))
    stg_order_events = property(lambda self: self.stg("order_events"))
    stg_payment_events = property(lambda self: self.stg("payment_events"))

    # -- intermediate ---------------------------------------------------
    @cached_property
    def order_item_agg(self) -> DataFrame:
        return self.item_totals(self.stg_order_items)

    def item_totals(self, items: DataFrame, deal: bool = False) -> DataFrame:
        """Line items summed per order (of the lines that are passed in); with
        ``deal``, lines are dealt by order first, not summed where they are read."""
        prods = self.stg_products.select("product_id", "cost_price")
        # of a line's own key the joins carry only whether it is there
        lines = items.select("order_id", "product_id", "quantity", "unit_price", "line_total",
                             F.col("order_item_id").isNotNull().alias("counted")).join(prods, "product_id", "inner")
        lines = self.dealt(lines, "order_id", "orders") if deal else lines
        margin = F.col("quantity") * (F.col("unit_price") - F.col("cost_price"))
        return lines.groupBy("order_id").agg(
            F.count_if("counted").alias("line_count"),
            F.sum("quantity").alias("item_count"),
            F.sum("line_total").alias("gross_revenue"),
            F.sum(margin).alias("gross_margin"))

    @cached_property
    def int_orders_enriched(self) -> DataFrame:
        return self.enrich(self.stg_orders, self.order_item_agg)

    def enriched_by_order(self) -> DataFrame:
        """``int_orders_enriched`` for readers of few columns, by tasks of bounded size."""
        return self.enrich(self.dealt(self.stg_orders, "order_id", "orders"), self.item_totals(self.stg_order_items, deal=True))

    def enriched_of(self, orders: DataFrame) -> DataFrame:
        """Some orders, enriched: only their line items reach the aggregate."""
        items = self.stg_order_items.join(orders.select("order_id"), "order_id", "left_semi")
        return self.enrich(orders, self.item_totals(items))

    @staticmethod
    def enrich(orders: DataFrame, totals: DataFrame) -> DataFrame:
        return orders.join(totals, "order_id", "inner").select(
            "order_id", "customer_id", "order_state", "order_date", "updated_at", "subtotal", "tax",
            "shipping_cost", "total_amount", "shipping_address_id", "is_stuck", "stuck_reason",
            "line_count", "item_count", "gross_revenue", "gross_margin")

    @staticmethod
    def _payment_cols(total_col: str = "total_amount"):
        diff = F.abs(F.col(total_col) - F.col("amount"))
        return diff, diff > F.lit(0.01), F.col("payment_state") == "refunded"

    @cached_property
    def int_orders_with_payments(self) -> DataFrame:
        o = self.stg_orders.select("order_id", "customer_id", "order_state", "order_date", "total_amount")
        j = self.dealt(o, "order_id", "orders").join(self.dealt(self.stg_payments, "order_id", "orders"), "order_id", "left")
        diff, has, refunded = self._payment_cols()
        return j.select(
            "order_id", "customer_id", "order_state", "order_date", "total_amount", "payment_id",
            "payment_method", "payment_state", F.col("amount").alias("payment_amount"), "payment_date",
            "authorization_date", "capture_date", "refund_date", "failure_reason",
            F.col("retry_count").alias("payment_retry_count"),
            diff.alias("amount_discrepancy"), has.alias("has_discrepancy"), refunded.alias("is_refunded"))

    @cached_property
    def transition_times(self) -> DataFrame:
        return self.transitions()

    def transitions(self, deal: bool = False) -> DataFrame:
        ev = self.stg_order_events.filter(F.col("new_state").isin("shipped", "delivered"))
        ev = self.dealt(ev, "order_id", "orders") if deal else ev
        ts, st = F.col("event_timestamp"), F.col("new_state")
        return ev.groupBy("order_id").agg(
            F.max(F.when(st == "shipped", ts)).alias("shipped_at"),
            F.max(F.when(st == "delivered", ts)).alias("delivered_at"))

    @staticmethod
    def _timeliness_cols():
        to_deliver = days_between("order_date", "delivered_at")
        return (days_between("order_date", "shipped_at").alias("days_to_ship"),
                to_deliver.alias("days_to_deliver"),
                F.when(F.col("delivered_at").isNotNull(), to_deliver <= SLA_DAYS).alias("is_on_time"))

    @cached_property
    def int_shipment_timeliness(self) -> DataFrame:
        o = self.stg_orders.select("order_id", "customer_id", "order_state", "order_date")
        j = self.dealt(o, "order_id", "orders").join(self.transitions(deal=True), "order_id", "left")
        ship, deliver, on_time = self._timeliness_cols()
        return j.select("order_id", "customer_id", "order_state", "order_date", "shipped_at",
                        "delivered_at", ship, deliver, F.lit(SLA_DAYS).alias("sla_days"), on_time)

    def customer_orders(self, orders: DataFrame) -> DataFrame:
        st = F.col("order_state")
        n = F.count("order_id")
        returned = F.count(F.when(st == "returned", 1))
        return orders.groupBy("customer_id").agg(
            n.alias("order_count"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
            F.sum("total_amount").alias("total_spend"),
            returned.alias("returned_order_count"),
            F.count(F.when(st == "cancelled", 1)).alias("cancelled_order_count"),
            safe_ratio(returned, n).alias("return_rate"),
            (F.max("order_date") >= F.date_sub(F.lit(self.as_of), 365)).alias("is_active"))

    @cached_property
    def int_customer_orders(self) -> DataFrame:
        return self.customer_orders(self.stg_orders)

    # -- snapshots & dimensions -----------------------------------------
    CUSTOMER_CHECK = ["first_name", "last_name", "email", "address_id"]
    PRODUCT_CHECK = ["product_name", "product_category", "unit_price", "cost_price"]

    @cached_property
    def customers_scd(self) -> DataFrame:
        return scd2_apply(None, self.stg_customers, "customer_id", self.CUSTOMER_CHECK, self.run_ts)

    @cached_property
    def products_scd(self) -> DataFrame:
        return scd2_apply(None, self.stg_products, "product_id", self.PRODUCT_CHECK, self.run_ts)

    def build_dim_customers(self, snapshot: DataFrame, customer_orders: DataFrame | None = None) -> DataFrame:
        c = scd2_current(snapshot)
        # addresses are one row per address: broadcast is decided by AQE from
        # the runtime size, never forced.
        a = self.stg_addresses.select("address_id", "city", "state", "postal_code", "country")
        co = self.int_customer_orders if customer_orders is None else customer_orders
        j = c.join(a, "address_id", "left").join(co, "customer_id", "left")
        return j.select(
            "customer_id", "first_name", "last_name", "email", "address_id", "city", "state",
            "postal_code", "country", "created_at",
            F.date_format("created_at", "yyyy-MM").alias("cohort_month"),
            F.year("created_at").alias("cohort_year"),
            F.coalesce(F.col("order_count"), F.lit(0)).alias("lifetime_order_count"),
            F.coalesce(F.col("total_spend"), F.lit(0)).alias("lifetime_spend"),
            "first_order_date", "last_order_date",
            F.coalesce(F.col("return_rate"), F.lit(0.0)).alias("return_rate"),
            F.coalesce(F.col("is_active"), F.lit(False)).alias("is_active"),
            customer_segment("order_count").alias("customer_segment"),
            "valid_from", "scd_id")

    @cached_property
    def dim_customers(self) -> DataFrame:
        return self.build_dim_customers(self.customers_scd)

    def build_dim_products(self, snapshot: DataFrame) -> DataFrame:
        p = scd2_current(snapshot)
        up, cp = F.col("unit_price"), F.col("cost_price")
        return p.select(
            "product_id", "sku", "product_name", "product_category", "unit_price", "cost_price",
            F.round(up - cp, 2).alias("gross_margin_amount"),
            F.round((up - cp) / F.nullif(up, F.lit(0)), 4).cast("double").alias("gross_margin_pct"),
            price_band(up).alias("price_band"),
            "valid_from", "scd_id")

    @cached_property
    def dim_products(self) -> DataFrame:
        return self.build_dim_products(self.products_scd)

    # -- facts ----------------------------------------------------------
    def build_fct_orders(self, enriched: DataFrame) -> DataFrame:
        pay = self.stg_payments.select(
            "order_id", "payment_id", "payment_method", "payment_state",
            F.col("amount").alias("payment_amount"), "payment_date")
        j = enriched.join(pay, "order_id", "left").join(self.transition_times, "order_id", "left")
        has = F.abs(F.col("total_amount") - F.col("payment_amount")) > F.lit(0.01)
        ship, deliver, on_time = self._timeliness_cols()
        st = F.col("order_state")
        return j.select(
            "order_id", "customer_id", F.col("order_date").cast("date").alias("order_date_day"),
            "order_date", "updated_at", "order_state", "shipping_address_id",
            "line_count", "item_count", "gross_revenue", "gross_margin",
            "subtotal", "tax", "shipping_cost", "total_amount",
            "payment_id", "payment_method", "payment_state", "payment_amount", "payment_date",
            has.alias("has_discrepancy"), (F.col("payment_state") == "refunded").alias("is_refunded"),
            "shipped_at", "delivered_at", ship, deliver, on_time,
            "is_stuck", "stuck_reason",
            (st == "returned").alias("is_returned"), (st == "cancelled").alias("is_cancelled"))

    @cached_property
    def fct_orders(self) -> DataFrame:
        return self.build_fct_orders(self.int_orders_enriched)

    def build_fct_payments(self, payments: DataFrame) -> DataFrame:
        o = self.stg_orders.select("order_id", "customer_id", "order_date", "order_state",
                                   F.col("total_amount").alias("order_amount"))
        j = payments.join(o, "order_id", "inner")
        ps = F.col("payment_state")
        return j.select(
            "payment_id", "order_id", "customer_id",
            F.col("order_date").cast("date").alias("order_date_day"), "order_date", "order_state",
            "payment_method", "payment_state", F.col("amount").alias("payment_amount"), "order_amount",
            (F.abs(F.col("order_amount") - F.col("amount")) > F.lit(0.01)).alias("has_discrepancy"),
            "payment_date", "authorization_date", "capture_date", "refund_date", "failure_reason",
            "retry_count",
            hours_between("payment_date", "authorization_date").alias("hours_to_authorize"),
            hours_between("authorization_date", "capture_date").alias("hours_to_capture"),
            (ps == "refunded").alias("is_refunded"), (ps == "failed").alias("is_failed"))

    @cached_property
    def fct_payments(self) -> DataFrame:
        return self.build_fct_payments(self.stg_payments)

    @cached_property
    def return_events(self) -> DataFrame:
        ev = self.stg_order_events.filter(F.col("new_state") == "returned")
        return ev.groupBy("order_id").agg(F.max("event_timestamp").alias("returned_at"))

    def build_fct_returns(self, fct_orders: DataFrame) -> DataFrame:
        o = fct_orders.filter(F.col("is_returned"))
        j = o.join(self.return_events, "order_id", "left")
        return j.select(
            "order_id", "customer_id", "order_date_day", "order_date",
            F.col("total_amount").alias("order_amount"), F.col("gross_margin").alias("order_margin"),
            "payment_id", "payment_method", F.col("payment_amount").alias("refund_amount"),
            "payment_state", "returned_at", days_between("order_date", "returned_at").alias("days_to_return"))

    @cached_property
    def fct_returns(self) -> DataFrame:
        returned = self.stg_orders.filter(F.col("order_state") == "returned")
        return self.build_fct_returns(self.build_fct_orders(self.enriched_of(returned)))

    # -- calendar -------------------------------------------------------
    def order_date_range(self) -> DataFrame:
        """One row (start, end) spanning the order dates, derived by Spark."""
        o = self.stg_orders
        return o.agg(F.min("order_date").cast("date").alias("start"),
                     F.max("order_date").cast("date").alias("end"))

    def time_spine(self, start=None, days: int | None = None) -> DataFrame:
        """Daily spine; by default spanning the data's own order dates."""
        if start is None:
            rng = self.order_date_range()
            return rng.select(F.explode(F.sequence("start", "end")).alias("date_day"))
        return (self.spark.range(days)
                .select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("date_day")))

    def dim_date(self, start=None, days: int | None = None) -> DataFrame:
        d = F.col("date_day")
        dow = day_of_week_sunday0(d)
        return self.time_spine(start, days).select(
            "date_day",
            dow.alias("day_of_week_num"),
            F.date_format(d, "EEE").alias("day_name"),
            F.dayofmonth(d).alias("day_of_month"),
            F.dayofyear(d).alias("day_of_year"),
            F.weekofyear(d).alias("week_of_year"),
            F.month(d).alias("month_num"),
            F.date_format(d, "MMM").alias("month_name"),
            F.quarter(d).alias("quarter_num"),
            F.year(d).alias("year_num"),
            trunc_date("week", d).alias("week_start_date"),
            trunc_date("month", d).alias("month_start_date"),
            trunc_date("quarter", d).alias("quarter_start_date"),
            F.date_format(d, "yyyy-MM").alias("year_month"),
            dow.isin(0, 6).alias("is_weekend"))
