"""The project's data tests: generic tests from the model contracts plus
the domain checks of the acceptance notebook and the state machine, and a
scorecard combining them.  Fixed values (thresholds, legal moves, accepted
sets) are stated together below.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.operators import quality as Q
from quayside.plans.staging import STAGING
from quayside.sources import schemas as S

# ---- fixed values -------------------------------------------------------
UNIQUE_TESTS = [
    ("stg_addresses", "address_id"), ("stg_customers", "customer_id"), ("stg_customers", "email"),
    ("stg_products", "product_id"), ("stg_products", "sku"), ("stg_orders", "order_id"),
    ("stg_order_items", "order_item_id"), ("stg_payments", "payment_id"), ("stg_payments", "order_id"),
    ("stg_order_events", "event_id"), ("stg_payment_events", "event_id"),
    ("int_orders_enriched", "order_id"), ("int_orders_with_payments", "order_id"), ("int_shipment_timeliness", "order_id"),
    ("int_customer_orders", "customer_id"), ("dim_customers", "customer_id"), ("dim_products", "product_id"),
    ("dim_products", "sku"), ("dim_date", "date_day"), ("time_spine", "date_day"), ("fct_orders", "order_id"),
    ("fct_payments", "payment_id"), ("fct_returns", "order_id"),
]
#: The source table that tells how many keys a model has (a staging model: its own);
#: models that aren't named have few.
KEYS_OF = {"int_orders_enriched": "orders", "int_orders_with_payments": "orders", "int_shipment_timeliness": "orders",
           "int_customer_orders": "customers", "dim_customers": "customers", "dim_products": "products",
           "fct_orders": "orders", "fct_payments": "payments", "fct_returns": "orders"}
#: Models whose rows come dealt by the key that is tested.
DEALT = ("int_orders_enriched", "int_orders_with_payments", "int_shipment_timeliness")
#: Marts that the tests read as stored.
STORED = ("fct_orders", "fct_payments", "fct_returns", "dim_customers")
ACCEPTED_TESTS = [
    ("stg_orders", "order_state", S.ORDER_STATES),
    ("stg_payments", "payment_state", S.PAYMENT_STATES),
    ("stg_order_events", "new_state", S.ORDER_STATES),
    ("stg_payment_events", "new_state", S.PAYMENT_STATES),
    ("dim_customers", "customer_segment", ("never_ordered", "one_time", "repeat", "loyal")),
    ("fct_orders", "order_state", S.ORDER_STATES),
    ("fct_payments", "payment_state", S.PAYMENT_STATES),
    ("dim_products", "price_band", ("budget", "mid_range", "premium", "luxury")),
]
RELATIONSHIP_TESTS = [
    ("stg_customers", "address_id", "stg_addresses", "address_id"),
    ("stg_orders", "customer_id", "stg_customers", "customer_id"),
    ("stg_orders", "shipping_address_id", "stg_addresses", "address_id"),
    ("stg_order_items", "order_id", "stg_orders", "order_id"),
    ("stg_order_items", "product_id", "stg_products", "product_id"),
    ("stg_payments", "order_id", "stg_orders", "order_id"),
    ("stg_order_events", "order_id", "stg_orders", "order_id"),
    ("stg_payment_events", "payment_id", "stg_payments", "payment_id"),
    ("fct_orders", "customer_id", "dim_customers", "customer_id"),
    ("fct_orders", "order_date_day", "dim_date", "date_day"),
    ("fct_payments", "order_id", "fct_orders", "order_id"),
    ("fct_payments", "customer_id", "dim_customers", "customer_id"),
    ("fct_returns", "order_id", "fct_orders", "order_id"),
    ("fct_returns", "customer_id", "dim_customers", "customer_id"),
]
# Legal lifecycle moves (previous_state, new_state); refunds may follow any state.
ORDER_MOVES = (("placed", "confirmed"), ("placed", "cancelled"), ("confirmed", "shipped"),
               ("confirmed", "cancelled"), ("shipped", "delivered"), ("shipped", "returned"),
               ("delivered", "returned"))
PAYMENT_MOVES = ((None, "pending"), ("pending", "authorized"), ("pending", "failed"),
                 ("authorized", "captured"), ("authorized", "failed"), ("failed", "pending"))
MAX_RETRIES = 3
ROW_MINIMUMS = {"addresses": 100_000, "customers": 200_000, "products": 10_000, "orders": 100_000,
                "order_items": 300_000, "payments": 100_000, "order_events": 300_000,
                "payment_events": 200_000}
# state -> (low, high, low is included, what a miss means)
ORDER_STATE_RANGES = {"delivered": (80, 95, True, "fail"), "returned": (3, 10, True, "fail"),
                      "cancelled": (3, 10, True, "fail"), "shipped": (0, 5, True, "fail")}
PAYMENT_STATE_RANGES = {"captured": (80, 100, False, "fail"), "refunded": (2, 10, True, "warn")}
RECENCY_HOURS = 24
FRESHNESS = {"orders": ("updated_at", 24, 48), "payment_events": ("event_timestamp", 24, 48)}
DQ_AS_OF = _dt.datetime(2001, 9, 2, 12, 0, 0)


def not_null_columns(table: str) -> list[str]:
    renamed = dict((c, c) if isinstance(c, str) else c for c in STAGING[table])
    return [renamed[f.name] for f in S.SOURCE_SCHEMAS[table].fields
            if not f.nullable and f.name in renamed]


class Checks:
    def __init__(self, warehouse, as_of=DQ_AS_OF):
        self.w, self.as_of = warehouse, as_of

    def _m(self, name) -> DataFrame:
        if name in STORED:
            return self.w.mart(name)
        model = getattr(self.w, name)
        return model() if callable(model) else model

    # generic -------------------------------------------------------------
    def unique(self) -> DataFrame:
        return Q.union_all([Q.unique(self.w.enriched_by_order() if m == "int_orders_enriched" else self._m(m), m, c, self._parts(m))
                            for m, c in UNIQUE_TESTS])

    def _parts(self, model: str) -> int:
        """Tasks for the keys of a model, by the rows of the table they come from."""
        table = KEYS_OF.get(model, model.removeprefix("stg_"))
        return 1 if model in DEALT or table not in STAGING else self.w.tasks(table)

    def not_null(self) -> DataFrame:
        return Q.union_all([Q.not_null(self._m(f"stg_{t}"), f"stg_{t}", not_null_columns(t))
                            for t in STAGING])

    def accepted_values(self) -> DataFrame:
        return Q.union_all([Q.accepted_values(self._m(m), m, c, v) for m, c, v in ACCEPTED_TESTS])

    def relationships(self) -> DataFrame:
        return Q.union_all([Q.relationships(self._m(m), m, c, self._m(p), p, pc)
                            for m, c, p, pc in RELATIONSHIP_TESTS])

    def recency(self) -> DataFrame:
        return Q.recency(self.w.mart("fct_orders"), "fct_orders", "updated_at", RECENCY_HOURS, self.as_of)

    def freshness(self) -> DataFrame:
        return Q.union_all([Q.freshness(self.w.source(src), src, col, warn, err, self.as_of)
                            for src, (col, warn, err) in FRESHNESS.items()])

    # domain ----------------------------------------------------------------
    def order_totals(self) -> DataFrame:
        """Subtotal vs sum of line items (orders with lines only), > 0.01 apart.
        Lines are summed per order before the join (map-side partial agg)."""
        items = self.w.stg_order_items.groupBy("order_id").agg(F.sum("line_total").alias("items_subtotal"))
        j = self.w.stg_orders.select("order_id", "subtotal").join(items, "order_id", "inner")
        delta = F.abs(F.col("subtotal") - F.col("items_subtotal"))
        return j.filter(delta > F.lit(0.01)).select(
            "order_id", F.col("subtotal").alias("order_subtotal"), "items_subtotal", delta.alias("delta"))

    def integrity(self) -> DataFrame:
        o = self.w.stg_orders
        c = self.w.stg_customers.select("customer_id", "created_at")
        e = self.w.stg_order_events.select("order_id", "event_timestamp")
        keys = o.select("order_id")
        checks = [
            ("order older than its customer",
             o.join(c, "customer_id").filter(F.col("order_date") < F.col("created_at"))),
            ("event older than its order",
             e.join(o.select("order_id", "order_date"), "order_id")
             .filter(F.col("event_timestamp") < F.col("order_date"))),
            ("order changed before it was placed", o.filter(F.col("updated_at") < F.col("order_date"))),
            ("line of an unknown order",
             self.w.stg_order_items.join(keys, "order_id", "left_anti")),
            ("payment of an unknown order", self.w.stg_payments.join(keys, "order_id", "left_anti")),
        ]
        return Q.union_all([Q.summary(name, df) for name, df in checks])

    def refund_le_total(self) -> DataFrame:
        p = self.w.mart("fct_payments")
        return p.filter(F.col("is_refunded") & (F.col("payment_amount") > F.col("order_amount"))).select(
            "payment_id", "order_id", F.col("payment_amount").alias("refund_amount"), "order_amount")

    def total_components(self) -> DataFrame:
        o = self.w.stg_orders.select("order_id", "subtotal", "tax", "shipping_cost", "total_amount")
        p = self.w.stg_payments.select("order_id", F.col("amount").alias("payment_amount"))
        j = o.join(p, "order_id", "left")
        comp_ok = F.coalesce(F.col("subtotal") + F.col("tax") + F.col("shipping_cost")
                             == F.col("total_amount"), F.lit(False))
        pay_ok = F.col("payment_amount").isNull() | (F.col("payment_amount") == F.col("total_amount"))
        return j.filter(~comp_ok | ~pay_ok).select(
            "order_id", "subtotal", "tax", "shipping_cost", "total_amount", "payment_amount",
            comp_ok.alias("components_ok"), pay_ok.alias("payment_ok"))

    @staticmethod
    def _legal(moves) -> F.Column:
        prev, new = F.col("previous_state"), F.col("new_state")
        terms = [((prev.isNull() if a is None else prev == a) & (new == b)) for a, b in moves]
        return reduce(lambda x, y: x | y, terms)

    def illegal_transitions(self) -> DataFrame:
        oe = self.w.stg_order_events
        pe = self.w.stg_payment_events
        bad_o = oe.filter(~F.coalesce(self._legal(ORDER_MOVES), F.lit(False)))
        bad_p = pe.filter(~F.coalesce(self._legal(PAYMENT_MOVES) | (F.col("new_state") == "refunded"),
                                      F.lit(False)))
        cols = ["event_id", "previous_state", "new_state", "event_timestamp"]
        return (bad_o.select(F.lit("order").alias("log"), F.col("order_id").alias("entity_id"), *cols)
                .unionByName(bad_p.select(F.lit("payment").alias("log"),
                                          F.col("payment_id").alias("entity_id"), *cols)))

    def paired_events(self) -> DataFrame:
        """Returned orders must have a refunded payment stamped at the return time."""
        o = self.w.stg_orders.filter(F.col("order_state") == "returned").select("order_id", "order_state")
        r = self.w.return_events
        p = self.w.stg_payments.select("order_id", "payment_id", "payment_state", "refund_date")
        j = o.join(r, "order_id", "left").join(p, "order_id", "left")
        issue = (F.when(F.col("payment_id").isNull(), "no_payment")
                 .when(F.col("payment_state") != "refunded", "not_refunded")
                 .when(~F.col("refund_date").eqNullSafe(F.col("returned_at")), "timestamp_mismatch"))
        return j.select("order_id", "payment_id", "order_state", "payment_state", "returned_at",
                        "refund_date", issue.alias("issue")).filter(F.col("issue").isNotNull())

    def event_monotonic(self) -> DataFrame:
        """Per order: events not before the order, each move continues the
        previous one, the last event equals updated_at.  Orders have a handful
        of events; the window is partitioned by order."""
        e = self.w.stg_order_events
        o = self.w.stg_orders.select("order_id", "order_date", "updated_at")
        w = Window.partitionBy("order_id").orderBy("event_timestamp", "event_id")
        wl = Window.partitionBy("order_id")
        j = (e.join(o, "order_id", "left")
             .withColumn("prev_new", F.lag("new_state").over(w))
             .withColumn("last_ts", F.max("event_timestamp").over(wl)))
        issues = F.array_compact(F.array(
            F.when(F.col("event_timestamp") < F.col("order_date"), F.lit("before_order")),
            F.when(F.col("event_timestamp").isNotNull() & F.col("order_date").isNull(), F.lit("no_order")),
            F.when(F.col("prev_new").isNotNull() & ~F.col("previous_state").eqNullSafe(F.col("prev_new")),
                   F.lit("continuity")),
            F.when((F.col("event_timestamp") == F.col("last_ts"))
                   & (F.col("updated_at") != F.col("last_ts")), F.lit("updated_at_mismatch"))))
        return (j.select("order_id", "event_id", "previous_state", "new_state", "event_timestamp",
                         F.explode(issues).alias("issue")))

    def retry_limit(self) -> DataFrame:
        fails = (self.w.stg_payment_events.filter(F.col("new_state") == "failed")
                 .groupBy("payment_id").agg(F.count(F.lit(1)).alias("failed_moves")))
        p = self.w.stg_payments.select("payment_id", "payment_state", "retry_count")
        j = p.join(fails, "payment_id", "left").fillna(0, ["failed_moves"])
        bad = ((F.col("retry_count") > MAX_RETRIES) | (F.col("failed_moves") > MAX_RETRIES)
               | ((F.col("payment_state") == "failed") & (F.col("failed_moves") != F.col("retry_count"))))
        return j.filter(bad)

    def share_ranges(self) -> DataFrame:
        def shares(df, col, domain, ranges):
            """One row per expected state, in one aggregate over one column; a
            state that doesn't occur has 0 rows and 0 %."""
            total = F.nullif(F.count(F.lit(1)), F.lit(0)).cast("double")
            row = df.agg(*[F.struct(
                F.lit(s).alias("state"), F.count(F.when(F.col(col) == s, 1)).alias("n"),
                F.coalesce(F.count(F.when(F.col(col) == s, 1)).cast("double") * 100 / total, F.lit(0.0)).alias("pct"),
                F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi"), F.lit(incl).alias("incl"),
                F.lit(miss).alias("miss")).alias(s) for s, (lo, hi, incl, miss) in ranges.items()])
            g = row.select(F.lit(domain).alias("domain"), F.inline(F.array(*ranges)))
            inside = (F.col("pct") > F.col("lo")) | (F.col("incl") & (F.col("pct") == F.col("lo")))
            return g.withColumn("status", F.when(inside & (F.col("pct") <= F.col("hi")), "pass")
                                .otherwise(F.col("miss"))).drop("incl", "miss")
        return shares(self.w.stg_orders, "order_state", "order", ORDER_STATE_RANGES).unionByName(
            shares(self.w.stg_payments, "payment_state", "payment", PAYMENT_STATE_RANGES))

    def row_minimums(self) -> DataFrame:
        frames = [self.w.source(t).agg(F.count(F.lit(1)).alias("row_count"))
                  .select(F.lit(t).alias("table_name"), "row_count",
                          F.lit(n).cast("long").alias("min_expected"))
                  for t, n in ROW_MINIMUMS.items()]
        return Q.union_all(frames).withColumn(
            "status", F.when(F.col("row_count") >= F.col("min_expected"), "pass").otherwise("fail"))

    def orders_without_items(self) -> DataFrame:
        items = self.w.stg_order_items.select("order_id")
        return self.w.stg_orders.join(items, "order_id", "left_anti").select("order_id")

    def scorecard(self) -> DataFrame:
        rows = [
            Q.summary("unique", self.unique()),
            Q.summary("not_null", self.not_null(), "failures"),
            Q.summary("accepted_values", self.accepted_values(), "n_rows"),
            Q.summary("relationships", self.relationships(), "failures"),
            Q.summary("order_totals_balance", self.order_totals()),
            self.integrity(),
            Q.summary("refund_le_total", self.refund_le_total()),
            Q.summary("total_components", self.total_components()),
            Q.summary("illegal_transitions", self.illegal_transitions()),
            Q.summary("paired_events", self.paired_events()),
            Q.summary("event_monotonic", self.event_monotonic()),
            Q.summary("retry_limit", self.retry_limit()),
            Q.summary("share_ranges", self.share_ranges().filter(F.col("status") != "pass")),
            Q.summary("row_minimums", self.row_minimums().filter(F.col("status") != "pass")),
            Q.summary("orders_without_items", self.orders_without_items(), severity="warn"),
            Q.summary("recency", self.recency().filter(F.col("status") != "pass"), severity="warn"),
            Q.summary("freshness", self.freshness().filter(F.col("status") != "pass"), severity="warn"),
        ]
        return Q.union_all(rows)
