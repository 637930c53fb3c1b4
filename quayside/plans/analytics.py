"""Exploration analytics of the acceptance notebooks, as Spark plans.

Every query aggregates first and only then applies windows: a window with
no partition (running totals, percent of total) sees one row per calendar
day / state / bucket — a size bounded by the calendar or the value domain,
never by the number of orders.  Rankings over entities (products) use the
distributed ``global_rank``; group-first picks use partial aggregation
(``min`` / ``max_by`` of a struct) instead of ``row_number`` windows, so a
hot key is combined map-side rather than sorted in one task.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.scalars import safe_ratio, trunc_date
from quayside.operators.ranking import exact_median, global_rank, value_counts


# Region -> IANA zone for local-hour analysis (fixed values).
REGION_TZ = {"AFRICA": "Africa/Lagos", "AMERICA": "America/New_York", "ASIA": "Asia/Shanghai",
             "EUROPE": "Europe/Paris", "MIDDLE EAST": "Asia/Dubai"}
HOUSEHOLD_CAP = 9
ORDERS_CAP = 10
AOV_BUCKET = 50
#: Years the year pivot always has a column for, with orders or without.
PIVOT_YEARS = tuple(range(1992, 2002))
LATEST_EVENTS = 20
#: A sketch of 2 ** 12 registers: a few kilobytes, whatever it has seen.
SKETCH_LG_K = 12
TOP_N, TOP_VALUES = 10, 50
CUSTOMERS_AS_OF = _dt.date(1996, 1, 1)


def _share(df: DataFrame, key: str, alias: str) -> DataFrame:
    g = df.groupBy(F.col(key).alias(alias)).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("pct", F.col("n").cast("double") * 100
                        / F.sum("n").over(Window.partitionBy()).cast("double"))


def sketch_error(lg_k: int = SKETCH_LG_K) -> float:
    """Relative standard error of a merged sketch's estimate (1.04 / sqrt of its registers)."""
    return 1.04 / (2 ** lg_k) ** 0.5


class Analytics:
    def __init__(self, w):
        self.w = w

    # -- calendar counts ------------------------------------------------
    def customers_daily(self):
        c = self.w.stg_customers
        return c.groupBy(F.col("created_at").cast("date").alias("day")).agg(
            F.count(F.lit(1)).alias("new_customers"))

    def customers_monthly(self):
        c = self.w.stg_customers
        return c.groupBy(trunc_date("month", "created_at").alias("month")).agg(
            F.count(F.lit(1)).alias("new_customers"))

    def customers_running_total(self):
        d = self.customers_daily()
        run = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
        return d.withColumn("cumulative_customers", F.sum("new_customers").over(run))

    def orders_daily(self):
        o = self.w.stg_orders
        return o.groupBy(F.col("order_date").cast("date").alias("day")).agg(
            F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("revenue"))

    def orders_monthly_gmv(self):
        o = self.w.stg_orders
        g = o.groupBy(trunc_date("month", "order_date").alias("month")).agg(
            F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("gmv"))
        return g.withColumn("aov", safe_ratio("gmv", "orders"))

    def orders_yoy_weekly(self, anchor_year: int = 2024, last_week: int | None = None):
        """Orders by ISO year and week.  ``week_anchor`` places every year's week
        on one calendar: the first day of ``anchor_year`` plus 7 days a week.
        ``last_week`` cuts later weeks (charts of 52 weeks); none by default."""
        d = F.col("order_date")
        week = F.weekofyear(d)
        o = self.w.stg_orders
        if last_week is not None:
            o = o.filter(week <= last_week)
        g = o.groupBy(F.extract(F.lit("YEAROFWEEK"), d).cast("int").alias("order_year"), week.alias("week_of_year")).agg(
            F.count(F.lit(1)).alias("orders"))
        return g.withColumn("week_anchor", F.date_add(F.make_date(F.lit(anchor_year), F.lit(1), F.lit(1)),
                                                      (F.col("week_of_year") - 1) * 7))

    def orders_yoy_pivot(self, years=PIVOT_YEARS, last_week: int | None = None):
        """Weeks down, years across: ``years`` and every other year the orders have
        (found by one small aggregate, a row for each year)."""
        wk = self.orders_yoy_weekly(last_week=last_week)
        held = {r[0] for r in wk.select("order_year").distinct().collect() if r[0] is not None}
        return wk.groupBy("week_of_year").pivot("order_year", sorted(held | set(years))).agg(F.sum("orders"))

    def latest_events(self, n: int = LATEST_EVENTS):
        """The latest order events (each partition keeps its own first n)."""
        e = self.w.stg_order_events.select("event_id", "order_id", "previous_state", "new_state", "event_timestamp")
        return e.orderBy(F.col("event_timestamp").desc(), F.col("event_id").desc()).limit(n)

    def december_by_day(self):
        o = self.w.stg_orders.filter(F.month("order_date") == 12)
        return o.groupBy(F.dayofmonth("order_date").alias("day_of_month")).agg(
            F.count(F.lit(1)).alias("orders"))

    def seasonal_lift(self):
        """Per year: early/late December orders and December vs the
        May–September monthly baseline."""
        o = self.w.stg_orders
        m, d = F.month("order_date"), F.dayofmonth("order_date")
        g = o.groupBy(F.year("order_date").alias("order_year")).agg(
            F.count(F.when((m == 12) & (d <= 15), 1)).alias("dec_early"),
            F.count(F.when((m == 12) & (d > 15), 1)).alias("dec_late"),
            F.count(F.when(m == 12, 1)).alias("dec_orders"),
            F.count(F.when(m == 1, 1)).alias("jan_orders"),
            F.count(F.when(m.between(5, 9), 1)).alias("summer_orders"))
        base = F.col("summer_orders").cast("double") / 5
        return g.select("order_year", "dec_early", "dec_late",
                        safe_ratio("dec_late", "dec_early").alias("late_early_ratio"),
                        (F.col("dec_orders").cast("double") / F.nullif(base, F.lit(0.0))).alias("december_lift"),
                        (F.col("jan_orders").cast("double") / F.nullif(base, F.lit(0.0))).alias("january_ratio"))

    # -- distinct counts by sketch ------------------------------------------
    def customer_sketches(self, lg_k: int = SKETCH_LG_K):
        """One mergeable HyperLogLog sketch of the ordering customers for each day."""
        o = self.w.stg_orders.filter(F.col("customer_id").isNotNull())
        return o.groupBy(F.col("order_date").cast("date").alias("day")).agg(F.hll_sketch_agg("customer_id", F.lit(lg_k)).alias("sketch"))

    @staticmethod
    def distinct_of(sketches: DataFrame, grain: str = "month") -> DataFrame:
        """Distinct customers by period, from stored daily sketches alone: days are
        merged, so no order is read again.  The relative standard error is
        ``sketch_error``; a sum of daily counts would count a customer each day."""
        merged = sketches.groupBy(trunc_date(grain, F.col("day")).alias(grain)).agg(F.hll_union_agg("sketch").alias("sketch"))
        return merged.select(grain, F.hll_sketch_estimate("sketch").alias("estimated_customers"))

    def distinct_exact(self, grain: str = "month") -> DataFrame:
        o = self.w.stg_orders
        return o.groupBy(trunc_date(grain, F.col("order_date")).alias(grain)).agg(F.countDistinct("customer_id").alias("exact_customers"))

    # -- products & economics ---------------------------------------------
    def category_revenue(self):
        i = self.w.stg_order_items.select("order_id", "product_id", "line_total")
        p = self.w.stg_products.select("product_id", "product_category")
        g = i.join(p, "product_id").groupBy("product_category").agg(
            F.countDistinct("order_id").alias("orders"), F.sum("line_total").alias("revenue"),
            F.count(F.lit(1)).alias("lines"))
        return g.withColumn("avg_line_value", safe_ratio("revenue", "lines"))

    def order_economics(self):
        o = self.w.stg_orders
        agg = o.agg(F.count(F.lit(1)).alias("total_orders"),
                    F.min("total_amount").alias("min_order_value"),
                    F.max("total_amount").alias("max_order_value"),
                    F.sum("total_amount").alias("total_gmv"),
                    F.round(F.avg((F.col("subtotal") / F.col("total_amount")).cast("double") * 100), 6)
                    .alias("avg_subtotal_pct"))
        agg = agg.withColumn("avg_order_value", safe_ratio("total_gmv", "total_orders"))
        return agg.crossJoin(exact_median(o, "total_amount", "median_order_value"))

    def items_per_order(self):
        per = self.w.stg_order_items.groupBy("order_id").agg(F.count(F.lit(1)).alias("cnt"))
        sizes = value_counts(per, "cnt")
        s = sizes.agg(F.sum("n").alias("orders"), F.sum(F.col("cnt") * F.col("n")).alias("items"),
                      F.min("cnt").alias("min_items"), F.max("cnt").alias("max_items"))
        s = s.select(safe_ratio("items", "orders").alias("avg_items_per_order"), "min_items", "max_items")
        return s.crossJoin(exact_median(sizes, "cnt", "median_items_per_order", count="n"))

    def orders_per_customer(self):
        per = self.w.stg_orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
        return per.groupBy(F.least(F.col("n"), F.lit(ORDERS_CAP)).alias("orders_placed")).agg(
            F.count(F.lit(1)).alias("customers"))

    def aov_histogram(self, bucket: int = AOV_BUCKET, below: float | None = None):
        """Orders by bucket of their value; ``below`` cuts the chart, none by default."""
        o = self.w.stg_orders
        if below is not None:
            o = o.filter(F.col("total_amount") < below)
        b = (F.floor(F.col("total_amount") / bucket) * bucket).cast("long")
        return o.groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("orders"))

    def customer_activity_rate(self):
        active = self.w.stg_orders.agg(F.countDistinct("customer_id").alias("customers_with_orders"))
        total = self.w.stg_customers.agg(F.count(F.lit(1)).alias("total_customers"))
        j = active.crossJoin(total)     # two single-row aggregates
        return j.withColumn("pct_active", F.col("customers_with_orders").cast("double") * 100
                            / F.nullif(F.col("total_customers").cast("double"), F.lit(0.0)))

    def order_transitions(self):
        e = self.w.stg_order_events
        t = F.concat(F.col("previous_state"), F.lit(" → "), F.col("new_state"))
        return e.groupBy(t.alias("transition")).agg(F.count(F.lit(1)).alias("events"))

    def column_cardinality(self):
        """distinct/rows per column of customers.  Each column is grouped on its
        own (a pruned scan and one shuffle of partial groups): several distincts
        in one aggregate would multiply every row by the number of columns."""
        c = self.w.stg_customers

        def one(x):
            g = c.groupBy(F.col(x).alias("v")).agg(F.count(F.lit(1)).alias("n"))
            return g.agg(F.count("v").alias("n_distinct"), F.sum("n").alias("n_rows")).select(
                F.lit(x).alias("column_name"), "n_distinct", "n_rows", safe_ratio("n_distinct", "n_rows").alias("cardinality"))

        return reduce(DataFrame.unionByName, [one(x) for x in c.columns])

    def order_state_share(self):
        return _share(self.w.stg_orders, "order_state", "order_state")

    def payment_state_share(self):
        return _share(self.w.stg_payments, "payment_state", "payment_state")

    def payment_method_share(self):
        return _share(self.w.stg_payments, "payment_method", "payment_method")

    def product_line_counts(self):
        i = self.w.stg_order_items
        return i.groupBy("product_id").agg(F.count(F.lit(1)).alias("line_count"))

    def top_products(self):
        """The products with the most lines, with their revenue and category.
        The ten are picked first (TakeOrderedAndProject), then looked up."""
        p = self.w.stg_products.select("product_id", "product_name", "product_category")
        top = (self.w.stg_order_items.groupBy("product_id")
               .agg(F.count(F.lit(1)).alias("line_count"), F.sum("line_total").alias("revenue"))
               .orderBy(F.col("line_count").desc(), F.col("product_id").asc()).limit(TOP_N))
        return top.join(p, "product_id", "left")

    def product_pareto(self):
        c = self.product_line_counts()
        r = global_rank(c, [F.col("line_count").desc(), F.col("product_id").asc()], "product_rank",
                        cum_of="line_count", cum_col="cum_lines")
        tot = c.agg(F.count(F.lit(1)).alias("n_products"), F.sum("line_count").alias("total_lines"))
        j = r.crossJoin(tot)          # single-row totals
        pct = F.col("product_rank").cast("double") / F.col("n_products").cast("double")
        return j.select("product_id", "line_count", "product_rank", pct.alias("rank_pct"),
                        (F.col("cum_lines").cast("double") / F.col("total_lines").cast("double"))
                        .alias("cum_share"), (pct <= 0.2).alias("in_top_20pct"))

    def zipf_fit(self):
        r = global_rank(self.product_line_counts(),
                        [F.col("line_count").desc(), F.col("product_id").asc()], "product_rank")
        # float accumulation order differs between engines: report 9 decimals
        return r.agg(F.round(F.regr_slope(F.log10(F.col("line_count").cast("double")),
                                          F.log10(F.col("product_rank").cast("double"))), 9).alias("slope"),
                     F.count(F.lit(1)).alias("n_products"))

    def value_frequency(self):
        c = self.w.stg_customers
        g = c.groupBy(F.col("last_name").alias("value")).agg(F.count(F.lit(1)).alias("n"))
        total = c.agg(F.count(F.lit(1)).alias("total"))      # one row
        top = g.orderBy(F.col("n").desc(), F.col("value").asc()).limit(TOP_VALUES).crossJoin(total)
        return top.select("value", "n", (F.col("n").cast("double") / F.col("total").cast("double")).alias("share"))

    # -- households & geography ------------------------------------------
    def household_cap(self):
        c = self.w.stg_customers
        return (c.groupBy("address_id").agg(F.count(F.lit(1)).alias("household_size"))
                .filter(F.col("household_size") > HOUSEHOLD_CAP))

    def household_primary(self):
        """First customer per address (earliest created_at, then id) by a
        partial aggregate of a struct — a hot address is combined map-side."""
        c = self.w.stg_customers
        first = F.min(F.struct("created_at", "customer_id"))
        return c.groupBy("address_id").agg(first.alias("p")).select(
            "address_id", F.col("p.customer_id").alias("primary_customer_id"),
            F.col("p.created_at").alias("primary_created_at"))

    def household_members(self):
        c = self.w.stg_customers.select("customer_id", "address_id", "created_at")
        j = c.join(self.household_primary(), "address_id", "inner")
        return j.select("customer_id", "address_id", "created_at",
                        (F.col("customer_id") == F.col("primary_customer_id")).alias("is_primary"),
                        "primary_customer_id", "primary_created_at")

    def household_order_violations(self):
        """Orders placed before the household's first customer existed."""
        c = self.w.stg_customers
        first = c.groupBy("address_id").agg(F.min("created_at").alias("household_first_created_at"))
        o = self.w.stg_orders.select("order_id", "customer_id", "order_date")
        j = (o.join(c.select("customer_id", "address_id"), "customer_id")
             .join(first, "address_id"))
        return j.filter(F.col("order_date") < F.col("household_first_created_at")).select(
            "order_id", "customer_id", "address_id", "order_date", "household_first_created_at")

    def geo_distribution(self):
        """Customer share vs order share by state (region); states present in
        only one population get 0 for the other."""
        a = self.w.stg_addresses.select("address_id", "state")
        cust = self.w.stg_customers.join(a, "address_id").groupBy("state").agg(
            F.count(F.lit(1)).alias("n"))
        orders = self.w.stg_orders.join(a.withColumnRenamed("address_id", "shipping_address_id"),
                                        "shipping_address_id").groupBy("state").agg(
            F.count(F.lit(1)).alias("n"))
        cs = cust.select("state", (F.col("n").cast("double") / F.sum("n").over(Window.partitionBy()).cast("double"))
                         .alias("customer_share"))
        os_ = orders.select("state", (F.col("n").cast("double") / F.sum("n").over(Window.partitionBy()).cast("double"))
                            .alias("order_share"))
        j = cs.join(os_, "state", "full_outer").fillna(0.0, ["customer_share", "order_share"])
        return j.withColumn("share_diff", F.col("order_share") - F.col("customer_share"))

    def orders_by_local_hour(self):
        o = self.w.stg_orders.select("order_id", "customer_id", "order_date")
        c = self.w.stg_customers.select("customer_id", "address_id")
        a = self.w.stg_addresses.select("address_id", "state")
        tz = None
        for region, zone in REGION_TZ.items():
            tz = (F.when(F.col("state") == region, zone) if tz is None
                  else tz.when(F.col("state") == region, zone))
        j = o.join(c, "customer_id").join(a, "address_id").withColumn("tz", tz.otherwise("UTC"))
        local = F.from_utc_timestamp(F.col("order_date"), F.col("tz"))
        return j.groupBy("state", F.hour(local).alias("local_hour")).agg(F.count(F.lit(1)).alias("orders"))

    # -- misc -------------------------------------------------------------
    def distinct_addresses(self):
        used = self.w.stg_orders.select(F.col("shipping_address_id").alias("address_id")).distinct()
        return used.join(self.w.stg_addresses, "address_id").select(
            "address_id", "city", "state", "postal_code", "country")

    def customers_as_of(self):
        c = self.w.stg_customers
        return c.filter(F.col("created_at") <= F.lit(CUSTOMERS_AS_OF).cast("timestamp"))

    def latest_order_state(self):
        e = self.w.stg_order_events
        latest = F.max_by(F.struct("new_state", "event_timestamp"), F.struct("event_timestamp", "event_id"))
        return e.groupBy("order_id").agg(latest.alias("l")).select(
            "order_id", F.col("l.new_state").alias("latest_state"),
            F.col("l.event_timestamp").alias("latest_event_at"))

    def row_counts(self):
        from functools import reduce
        frames = [self.w.source(t).agg(F.count(F.lit(1)).alias("row_count"))
                  .select(F.lit(t).alias("table_name"), "row_count")
                  for t in ("addresses", "customers", "products", "orders", "order_items", "payments",
                            "order_events", "payment_events")]
        return reduce(lambda a, b: a.unionByName(b), frames).orderBy("table_name")
