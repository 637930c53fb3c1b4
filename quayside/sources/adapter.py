"""Driver tables (TPC-H-like) -> the eight retail source tables.

Deterministic rules (documented in FIXTURES.md §4); ``k`` is the order key.
Several ``k % n`` rules plant known defects so that every data-quality
check has rows to find.  Every table is a lazy DataFrame: nothing is
materialised, so Catalyst prunes the columns and joins a consumer does
not need.

Scale notes
-----------
* ``order_core`` is a pure projection of the ``orders`` scan (no join), and
  payments and both event logs derive from it, so they never pay for the
  lineitem aggregate or the customer join that only ``orders()`` needs.
* ``orders()`` joins one partial-aggregated lineitem sum per order (map-side
  combine, then one shuffle on the order key) and the customer's nation
  (shuffle on the customer key; AQE turns it into a broadcast only when the
  runtime size is under the threshold).
* Event logs are one ``inline`` of a per-order array: one pass, no union of
  rescans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.sources import schemas as S
from quayside.sources.testdata import read_table

MONEY = "decimal(12,2)"


def _hours(ts: Column, n: Column) -> Column:
    return F.timestamp_add("HOUR", n, ts)


def _days(ts: Column, n: Column) -> Column:
    return F.timestamp_add("DAY", n, ts)


def _minutes(ts: Column, n: Column) -> Column:
    return F.timestamp_add("MINUTE", n, ts)


class RetailSource:
    """The retail source database, derived from one driver scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def _t(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    # -- orders ---------------------------------------------------------
    def order_core(self) -> DataFrame:
        """All orders with state and lifecycle times (no joins)."""
        o = self._t("orders")
        k, ck = F.col("o_orderkey"), F.col("o_custkey")
        ck = self._customer(k, ck)
        status, prio = F.col("o_orderstatus"), F.col("o_orderpriority")
        state = (F.when(status == "O",
                        F.when(prio.isin("1-URGENT", "2-HIGH"), "confirmed")
                        .when(prio == "5-LOW", "cancelled").otherwise("placed"))
                 .when(status == "P", "shipped")
                 .otherwise(F.when(prio == "5-LOW", "returned").otherwise("delivered")))
        od = F.col("o_orderdate").cast("timestamp")
        return o.select(
            k.alias("k"),
            ck.alias("custkey"),
            state.alias("order_state"),
            od.alias("order_date"),
            F.col("o_totalprice").cast(MONEY).alias("total_amount"),
        ).select(
            "*",
            _hours(F.col("order_date"), 1 + F.col("k") % 20).alias("confirmed_at"),
            F.when((F.col("k") % 200) != 7,
                   _days(F.col("order_date"), 1 + F.col("k") % 3)).alias("shipped_at"),
            _days(F.col("order_date"), 4 + F.col("k") % 7).alias("delivered_at"),
            _days(F.col("order_date"), 12 + F.col("k") % 20).alias("returned_at"),
        )

    @staticmethod
    def _customer(k: Column, ck: Column) -> Column:
        """The customer an order belongs to: those with key % 20 = 0 never order
        and those with 1..3 rarely do, so their orders go to one of the sixteen
        customers before them (after them, for the first three)."""
        back, ahead, spread = F.lit(16), F.lit(4), k % 16
        r = ck % 20
        return (F.when((r > 3) | ((r > 0) & (k % 10 == 0)), ck)
                .when(ck > 3, ck - r - back + spread)
                .otherwise(ck - r + ahead + spread))

    @staticmethod
    def _updated_at() -> Column:
        st = F.col("order_state")
        return (F.when(st == "placed", F.col("order_date"))
                .when(st.isin("confirmed", "cancelled"), F.col("confirmed_at"))
                .when(st == "shipped", F.coalesce(F.col("shipped_at"), F.col("confirmed_at")))
                .when(st == "delivered", F.col("delivered_at"))
                .otherwise(F.col("returned_at")))

    def orders(self) -> DataFrame:
        # the joins carry only what is used after them
        core = self.order_core().select("k", "custkey", "order_state", "order_date", "total_amount", self._updated_at().alias("updated_at"))
        li = self._t("lineitem")
        line_sum = (li.groupBy(F.col("l_orderkey").alias("k"))
                    .agg(F.sum(F.col("l_extendedprice").cast(MONEY)).alias("line_sum")))
        cust = self._t("customer").select(F.col("c_custkey").alias("custkey"),
                                          F.col("c_nationkey").alias("nationkey"))
        joined = core.join(line_sum, "k", "left").join(cust, "custkey", "left")
        stuck = (F.col("order_state") == "shipped") & ((F.col("k") % 100) == 1)
        subtotal = (F.coalesce(F.col("line_sum"), F.lit(0))
                    + F.when((F.col("k") % 50) == 0, F.lit(1)).otherwise(F.lit(0)))
        return joined.select(
            F.col("k").cast("string").alias("order_id"),
            F.col("custkey").cast("string").alias("customer_id"),
            "order_state",
            "order_date",
            "updated_at",
            subtotal.cast(MONEY).alias("subtotal"),
            # every tenth order's total differs from its components (a planted defect)
            F.when(F.col("k") % 10 == 0, F.lit(0)).otherwise(F.col("total_amount") - subtotal).cast(MONEY).alias("tax"),
            F.lit(0).cast(MONEY).alias("shipping_cost"),
            "total_amount",
            F.col("nationkey").cast("string").alias("shipping_address_id"),
            stuck.alias("is_stuck"),
            F.when(stuck, F.lit("system_error")).alias("stuck_reason"),
            F.col("order_date").alias("first_event_at"),
        )

    def order_items(self) -> DataFrame:
        li = self._t("lineitem")
        return li.select(
            F.concat_ws("-", F.col("l_orderkey").cast("string"),
                        F.col("l_linenumber").cast("string")).alias("order_item_id"),
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.floor(F.col("l_quantity")).cast("int").alias("quantity"),
            F.floor(F.col("l_extendedprice") / F.nullif(F.col("l_quantity"), F.lit(0.0)))
            .cast(MONEY).alias("unit_price"),
            F.col("l_extendedprice").cast(MONEY).alias("total_price"),
        )

    def products(self) -> DataFrame:
        p = self._t("part")
        return p.select(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.concat_ws("-", F.col("p_brand"), F.col("p_partkey").cast("string")).alias("sku"),
            F.col("p_name").alias("name"),
            (F.col("p_size") * 5).cast(MONEY).alias("price"),
            (F.col("p_size") * 3).cast(MONEY).alias("cost_price"),
            F.col("p_type").alias("category"),
        )

    def customers(self) -> DataFrame:
        c = self._t("customer")
        created = F.date_add(F.lit("1995-01-01").cast("date"),
                             (F.col("c_custkey") % 700).cast("int")).cast("timestamp")
        return c.select(
            F.col("c_custkey").cast("string").alias("customer_id"),
            F.col("c_name").alias("first_name"),
            F.col("c_mktsegment").alias("last_name"),
            F.concat(F.lower(F.col("c_name")), F.lit("@example.com")).alias("email"),
            F.col("c_nationkey").cast("string").alias("address_id"),
            created.alias("created_at"),
        )

    def addresses(self) -> DataFrame:
        # nation (25 rows) x region (5 rows): both fixed-size reference tables.
        n, r = self._t("nation"), self._t("region")
        return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left").select(
            F.col("n_nationkey").cast("string").alias("address_id"),
            F.lit("1 Market Street").alias("street_address"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.lit("00000").alias("postal_code"),
            F.lit("US").alias("country"),
        )

    # -- payments ---------------------------------------------------------
    def _payment_core(self) -> DataFrame:
        core = self.order_core().filter((F.col("k") % 25) != 0)
        st, k = F.col("order_state"), F.col("k")
        pstate = (F.when(st == "placed", "pending")
                  .when(st == "confirmed", "authorized")
                  .when(st == "cancelled", "failed")
                  .when(st == "returned",
                        F.when((k % 30) == 2, "captured").otherwise("refunded"))
                  .otherwise("captured"))
        return core.withColumn("payment_state", pstate)

    def payments(self) -> DataFrame:
        p = self._payment_core()
        st, k, ps, od = F.col("order_state"), F.col("k"), F.col("payment_state"), F.col("order_date")
        failed = ps == "failed"
        return p.select(
            F.concat(F.lit("pay_"), k.cast("string")).alias("payment_id"),
            k.cast("string").alias("order_id"),
            "payment_state",
            (F.col("total_amount")
             + F.when((k % 40) == 0, F.lit(0.05).cast(MONEY)).otherwise(F.lit(0).cast(MONEY)))
            .cast(MONEY).alias("amount"),
            F.when((k % 3) == 0, "credit_card").when((k % 3) == 1, "paypal")
            .otherwise("debit_card").alias("payment_method"),
            _minutes(od, k % 90).alias("payment_date"),
            F.when(~st.isin("placed", "cancelled"), _minutes(od, 30 + k % 300))
            .alias("authorization_date"),
            F.when(st.isin("shipped", "delivered", "returned"), _hours(od, 6 + k % 48))
            .alias("capture_date"),
            F.when(ps == "refunded", F.col("returned_at")).alias("refund_date"),
            F.when(failed, F.lit("declined")).alias("failure_reason"),
            # one failed payment in twenty was retried too often (a planted defect)
            F.when(failed & (k % 20 == 3), F.lit(4)).when(failed, F.lit(1)).otherwise(F.lit(0)).alias("retry_count"),
        )

    # -- event logs -------------------------------------------------------
    def order_events(self) -> DataFrame:
        core = self.order_core()
        st, k = F.col("order_state"), F.col("k")
        later = ("shipped", "delivered", "returned")

        def ev(n, cond, prev, new, ts):
            return F.when(cond, F.struct(
                F.concat(k.cast("string"), F.lit(f"-{n}")).alias("event_id"),
                k.cast("string").alias("order_id"),
                prev.alias("previous_state"),
                new.alias("new_state"),
                ts.alias("event_timestamp"),
                F.lit(None).cast("string").alias("reason"),
                F.lit(0).alias("retry_count")))

        events = F.array(
            ev(1, st != "placed", F.lit("placed"),
               F.when(st == "cancelled", "cancelled").otherwise("confirmed"), F.col("confirmed_at")),
            ev(2, st.isin(*later) & F.col("shipped_at").isNotNull(), F.lit("confirmed"),
               F.lit("shipped"), F.col("shipped_at")),
            ev(3, st.isin("delivered", "returned"),
               F.when((k % 150) == 11, "placed").otherwise("shipped"), F.lit("delivered"),
               F.col("delivered_at")),
            ev(4, st == "returned", F.lit("delivered"), F.lit("returned"), F.col("returned_at")),
        )
        return (core.select(F.filter(events, lambda e: e.isNotNull()).alias("ev"))
                .select(F.inline("ev")))

    def payment_events(self) -> DataFrame:
        p = self.payments()
        pid = F.col("payment_id")

        def ev(n, ts, prev, new, reason=None, attempt=0):
            return F.when(ts.isNotNull(), F.struct(
                F.concat(pid, F.lit(f"-{n}")).alias("event_id"),
                pid.alias("payment_id"),
                F.lit(prev).cast("string").alias("previous_state"),
                F.lit(new).alias("new_state"),
                ts.alias("event_timestamp"),
                F.lit(reason).cast("string").alias("failure_reason"),
                F.lit(attempt).alias("retry_attempt")))

        failed_at = F.when(F.col("payment_state") == "failed", F.col("payment_date"))
        events = F.array(
            ev(1, F.col("payment_date"), None, "pending"),
            ev(2, F.col("authorization_date"), "pending", "authorized"),
            ev(3, F.col("capture_date"), "authorized", "captured"),
            ev(4, F.col("refund_date"), "captured", "refunded"),
            ev(5, failed_at, "pending", "failed", "declined", 1),
            # a state that no contract knows (a planted defect)
            ev(6, F.when(F.substring("payment_id", 5, 20).cast("long") % 37 == 0, failed_at), "failed", "lost", "unknown", 1),
        )
        return (p.select(F.filter(events, lambda e: e.isNotNull()).alias("ev"))
                .select(F.inline("ev")))

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)()


def conform(df: DataFrame, schema) -> DataFrame:
    """Cast/select to a declared schema (column order and types)."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def retail_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    src = RetailSource(spark, sf_dir)
    return {name: conform(src.table(name), sch) for name, sch in S.SOURCE_SCHEMAS.items()}
