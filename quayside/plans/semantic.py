"""Semantic layer: measures and metrics as data, compiled to DataFrames.

``query(w, metrics, group_by)`` plays the role of a metric query:

* each *measure* is aggregated once per (time dimension, offset) group on
  the order fact, joined to the customer dimension only when a customer
  dimension is requested (only the requested columns are carried);
* groups are combined with a NULL-safe FULL OUTER join on the group keys
  (keys coalesced), so a period present in one input only still appears;
* ``derived`` metrics are Column expressions over the combined inputs;
* an ``offset`` input (e.g. prior week) is the same measure aggregated with
  its period shifted forward, so gaps give NULL rather than the previous
  non-empty period (which ``lag`` would return);
* ``cumulative`` metrics are a running sum over a daily spine derived from
  the data, computed after aggregation to period grain (the window sees one
  row per period, never raw orders).

Facts and dimensions are *models* with entities (keys).  A dimension of another
model is reached along declared keys, always from a foreign key to the model
whose primary key it is (many to one), by the shortest such path; a path that
would multiply the measured rows doesn't exist, and asking for it raises.

Group-by names follow the metric-query convention: ``metric_time__<grain>``
and ``<entity>__<dimension>`` (``customer__customer_segment``).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.scalars import trunc_date

GRAINS = ("day", "week", "month", "quarter", "year")


@dataclass(frozen=True)
class Measure:
    name: str
    agg: str                      # "sum" | "count"
    expr: object                  # column name or callable -> Column
    time_dim: str = "order_date"  # column of the model, or of one reached by "<entity>__<column>"
    model: str = "orders"

    def column(self) -> Column:
        e = self.expr() if callable(self.expr) else F.col(self.expr)
        return F.count(e) if self.agg == "count" else F.sum(e)


@dataclass(frozen=True)
class MetricInput:
    metric: str
    alias: str | None = None
    offset_days: int = 0


@dataclass(frozen=True)
class Metric:
    name: str
    kind: str                              # simple | derived | cumulative
    measure: str | None = None
    expr: object = None                    # callable(dict alias->Column) -> Column
    inputs: tuple = field(default_factory=tuple)


def _flag(c):
    return lambda: F.when(F.col(c), F.lit(1)).otherwise(F.lit(0))


# Measures of the orders semantic model (fixed definitions).
MEASURES = {m.name: m for m in (
    Measure("order_count", "count", "order_id"),
    Measure("revenue", "sum", "total_amount"),
    Measure("gross_revenue", "sum", "gross_revenue"),
    Measure("gross_margin", "sum", "gross_margin"),
    Measure("returned_orders", "sum", _flag("is_returned")),
    Measure("cancelled_orders", "sum", _flag("is_cancelled")),
    Measure("shipped_revenue", "sum",
            lambda: F.when(F.col("order_state") == "delivered", F.col("total_amount")),
            time_dim="shipped_at"),
    Measure("items_sold", "sum", "quantity", time_dim="order__order_date", model="order_items"),
    Measure("item_revenue", "sum", "line_total", time_dim="order__order_date", model="order_items"),
)}


def _ratio(a: str, b: str):
    return lambda m: m[a].cast("double") / F.nullif(m[b].cast("double"), F.lit(0.0))


METRICS = {m.name: m for m in (
    Metric("order_count", "simple", measure="order_count"),
    Metric("revenue", "simple", measure="revenue"),
    Metric("returned_orders", "simple", measure="returned_orders"),
    Metric("shipped_revenue", "simple", measure="shipped_revenue"),
    Metric("gross_revenue", "simple", measure="gross_revenue"),
    Metric("gross_margin", "simple", measure="gross_margin"),
    Metric("cancelled_orders", "simple", measure="cancelled_orders"),
    Metric("items_sold", "simple", measure="items_sold"),
    Metric("item_revenue", "simple", measure="item_revenue"),
    Metric("average_item_price", "derived", expr=_ratio("item_revenue", "items_sold"),
           inputs=(MetricInput("item_revenue"), MetricInput("items_sold"))),
    Metric("average_order_value", "derived", expr=_ratio("revenue", "order_count"),
           inputs=(MetricInput("revenue"), MetricInput("order_count"))),
    Metric("return_rate", "derived", expr=_ratio("returned_orders", "order_count"),
           inputs=(MetricInput("order_count"), MetricInput("returned_orders"))),
    Metric("cumulative_revenue", "cumulative", measure="revenue"),
    Metric("revenue_wow", "derived",
           expr=lambda m: ((m["revenue"] - m["revenue_prior_week"]).cast("double")
                           / F.nullif(m["revenue_prior_week"].cast("double"), F.lit(0.0)) * 100),
           inputs=(MetricInput("revenue"), MetricInput("revenue", "revenue_prior_week", 7))),
)}

@dataclass(frozen=True)
class Model:
    """A table of the semantic layer: how to get it, its keys and its dimensions."""
    name: str
    frame: object                          # callable(warehouse) -> DataFrame
    primary: tuple[str, str]               # (entity, column)
    foreign: tuple = ()                    # ((entity, column), ...)
    dims: tuple = ()
    times: tuple = ()                      # time columns


# Semantic models (fixed definitions).
MODELS = {m.name: m for m in (
    Model("orders", lambda w: w.mart("fct_orders"), ("order", "order_id"), (("customer", "customer_id"),),
          ("order_state", "payment_method", "payment_state", "is_returned", "is_cancelled", "is_on_time"),
          ("order_date", "shipped_at")),
    Model("customers", lambda w: w.mart("dim_customers"), ("customer", "customer_id"), (),
          ("cohort_month", "cohort_year", "state", "customer_segment", "is_active")),
    Model("products", lambda w: w.mart("dim_products"), ("product", "product_id"), (), ("product_category", "price_band")),
    Model("order_items", lambda w: w.stg_order_items, ("order_item", "order_item_id"),
          (("order", "order_id"), ("product", "product_id"))),
)}
OWNER = {m.primary[0]: m for m in MODELS.values()}
ORDER_DIMS, CUSTOMER_DIMS = MODELS["orders"].dims, MODELS["customers"].dims


def join_path(model: str, entity: str) -> list[tuple[Model, str, Model]]:
    """Joins (from model, entity, to model) that lead from ``model`` to the model
    whose primary key ``entity`` is: breadth first, so the shortest, over foreign
    keys only, so that no measured row is ever multiplied."""
    if entity not in OWNER:
        raise ValueError(f"unknown entity {entity}")
    todo, paths = [MODELS[model]], {model: []}
    while todo:
        here = todo.pop(0)
        if here is OWNER[entity]:
            return paths[here.name]
        for e, _ in here.foreign:
            there = OWNER[e]
            if there.name not in paths:
                paths[there.name] = [*paths[here.name], (here, e, there)]
                todo.append(there)
    raise ValueError(f"{entity} can't be reached from {model} without multiplying its rows")


def _parse_group_by(group_by):
    time_grain, dims = None, []
    for g in group_by:
        if g.startswith("metric_time__"):
            time_grain = g.split("__", 1)[1]
            if time_grain not in GRAINS:
                raise ValueError(f"unknown grain {time_grain}")
        else:
            entity, _, dim = g.partition("__")
            if entity in OWNER and (dim in OWNER[entity].dims or (
                    entity == "order" and dim.startswith("shipped_date__") and dim.split("__")[1] in GRAINS)):
                dims.append((g, entity, dim))
            else:
                raise ValueError(f"unknown dimension {g}")
    return time_grain, dims


class SemanticLayer:
    def __init__(self, warehouse):
        self.w = warehouse

    def _base(self, model: str, dims, where=None, time_dim: str | None = None) -> DataFrame:
        """The model's rows with the columns of other models that are asked for, as
        ``<entity>__<column>``; ``where`` filters these rows, before any aggregate."""
        m = MODELS[model]
        f = m.frame(self.w)
        asked: dict[str, list[str]] = {}

        def ask(entity, column):
            if column not in asked.setdefault(entity, []):
                asked[entity].append(column)

        for _, e, d in dims:
            ask(e, "shipped_at" if d.startswith("shipped_date__") else d)
        if where is not None:
            for e, owner in OWNER.items():
                for d in owner.dims:
                    if f"{e}__{d}" in where:
                        ask(e, d)
        if time_dim and "__" in time_dim:
            ask(*time_dim.split("__", 1))
        own = asked.pop(m.primary[0], [])
        f = f.withColumns({f"{m.primary[0]}__{c}": F.col(c) for c in {*own, *m.dims}})
        # each model on the way is joined once, with the keys that lead on and the columns asked for
        steps, wanted = {}, {}
        for e, columns in asked.items():
            path = join_path(model, e)
            for i, (_, key, there) in enumerate(path):
                steps.setdefault(there.name, (path[i - 1][1] if i else None, key, there))
                if i + 1 < len(path):
                    wanted.setdefault(there.name, []).append(path[i + 1][1])
            wanted.setdefault(OWNER[e].name, [])
            wanted[OWNER[e].name] += [("column", c) for c in columns]
        for name, (came_by, key, there) in steps.items():
            left = f"__{came_by}__{key}" if came_by else dict(m.foreign)[key]
            leads = {k: dict(there.foreign)[k] for k in wanted[name] if isinstance(k, str)}
            right = there.frame(self.w).select(
                F.col(there.primary[1]).alias(f"__{name}"), *[F.col(c).alias(f"__{key}__{k}") for k, c in leads.items()],
                *[F.col(w[1]).alias(f"{key}__{w[1]}") for w in wanted[name] if not isinstance(w, str)])
            f = f.join(right, F.col(left) == F.col(f"__{name}"), "left").drop(f"__{name}")
        return f if where is None else f.filter(where)

    def _measure_frame(self, measures, time_grain, dims, time_dim, offset_days, where, model="orders") -> DataFrame:
        """An offset shifts days, so it is applied to the day before days are
        rolled up to the grain (a shifted month is not a month)."""
        base, keys = self._base(model, dims, where, time_dim if time_grain else None), []
        if time_grain:
            day = F.date_add(F.col(time_dim).cast("date"), offset_days) if offset_days else F.col(time_dim)
            base = base.withColumn(f"metric_time__{time_grain}", trunc_date(time_grain, day))
            keys.append(f"metric_time__{time_grain}")
        elif offset_days:
            raise ValueError("a metric with an offset needs metric_time in group_by")
        for out, _e, _d in dims:
            if out.startswith("order__shipped_date__"):
                base = base.withColumn(out, trunc_date(out.rsplit("__", 1)[1], F.col("order__shipped_at")))
            keys.append(out)
        aggs = [MEASURES[m].column().alias(alias) for m, alias in measures]
        return base.groupBy(*keys).agg(*aggs) if keys else base.agg(*aggs)

    @staticmethod
    def _combine(frames, keys) -> DataFrame:
        if not keys:
            return reduce(lambda a, b: a.crossJoin(b), frames)   # 1-row frames only

        def fo(a, b):
            cond = reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])
            j = a.alias("a").join(b.alias("b"), cond, "full_outer")
            rest = [c for c in a.columns + b.columns if c not in keys]
            return j.select(*[F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in keys],
                            *[F.col(c) for c in rest])
        return reduce(fo, frames)

    def query(self, metrics, group_by=(), where=None, order_by=None, limit=None,
              period_agg: str = "first") -> DataFrame:
        """``where`` filters facts: an SQL condition over fact columns,
        ``order__<dimension>`` and ``customer__<dimension>``."""
        time_grain, dims = _parse_group_by(group_by)
        keys = ([f"metric_time__{time_grain}"] if time_grain else []) + [o for o, _, _ in dims]

        # collect (measure, alias, offset) inputs
        needs: dict[tuple, list] = {}
        exprs = {}
        cumulative = []
        for name in metrics:
            m = METRICS[name]
            if m.kind == "simple":
                lst = needs.setdefault((MEASURES[m.measure].model, MEASURES[m.measure].time_dim, 0), [])
                if (m.measure, name) not in lst:
                    lst.append((m.measure, name))
            elif m.kind == "derived":
                for inp in m.inputs:
                    base = METRICS[inp.metric]
                    alias = inp.alias or inp.metric
                    key = (MEASURES[base.measure].model, MEASURES[base.measure].time_dim, inp.offset_days)
                    if (base.measure, alias) not in needs.setdefault(key, []):
                        needs[key].append((base.measure, alias))
                exprs[name] = m
            else:
                cumulative.append(m)

        frames = [self._measure_frame(ms, time_grain, dims, td, off, where, model)
                  for (model, td, off), ms in needs.items() if ms]
        out = self._combine(frames, keys) if frames else None
        for c in cumulative:
            cf = self._cumulative(c, time_grain, dims, period_agg, where)
            out = cf if out is None else self._combine([out, cf], keys)
        cols = {c: F.col(c) for c in out.columns}
        for name, m in exprs.items():
            out = out.withColumn(name, m.expr(cols))
        out = out.select(*keys, *metrics)
        if order_by:
            out = out.orderBy(*order_by)
        if limit:
            out = out.limit(limit)
        return out

    def _cumulative(self, m: Metric, time_grain, dims, period_agg, where=None) -> DataFrame:
        """Running sum over a daily spine, for each combination of the dimensions.
        The windows see one row per day and combination, never orders."""
        grain, names = time_grain or "day", [o for o, _, _ in dims]
        daily = self._measure_frame([(m.measure, "v")], "day", dims, MEASURES[m.measure].time_dim, 0, where, MEASURES[m.measure].model)
        daily = daily.withColumnRenamed("metric_time__day", "date_day")
        spine = self.w.time_spine()
        if names:
            groups = daily.select(*names).distinct().withColumn("__day", F.lit(True))
            spine = (spine.agg(F.min("date_day").alias("lo"), F.max("date_day").alias("hi")).crossJoin(groups)   # one row
                     .select(*names, F.explode(F.sequence("lo", "hi")).alias("date_day")))
        on = reduce(lambda x, y: x & y, [spine[k].eqNullSafe(daily[k]) for k in ["date_day", *names]])
        s = spine.join(daily, on, "left").select(spine["date_day"], *[spine[k] for k in names], "v")
        run = F.sum(F.coalesce(F.col("v"), F.lit(0))).over(
            Window.partitionBy(*names).orderBy("date_day").rowsBetween(Window.unboundedPreceding, 0))
        s = s.withColumn(m.name, run)
        if grain == "day":
            return s.select(F.col("date_day").alias("metric_time__day"), *names, m.name)
        period = trunc_date(grain, F.col("date_day"))
        pick = {"first": F.min_by, "last": F.max_by}
        if period_agg in pick:
            v = pick[period_agg](F.col(m.name), F.col("date_day"))
        else:
            v = F.avg(F.col(m.name))
        return s.groupBy(period.alias(f"metric_time__{grain}"), *names).agg(v.alias(m.name))


# Saved queries of the reference project (fixed definitions).
SAVED_QUERIES = {
    "weekly_revenue_by_segment": (("revenue", "order_count"),
                                  ("metric_time__week", "customer__customer_segment")),
    "customer_cohort_aov": (("average_order_value", "order_count"),
                            ("customer__cohort_month", "customer__customer_segment")),
    "return_rate_trend": (("return_rate", "order_count", "revenue"), ("metric_time__month",)),
}


def saved_query(warehouse, name: str) -> DataFrame:
    metrics, group_by = SAVED_QUERIES[name]
    return SemanticLayer(warehouse).query(list(metrics), list(group_by))


def publish_views(warehouse) -> list[str]:
    """Register every saved query as a temp view (metrics as SQL views)."""
    names = []
    for name in SAVED_QUERIES:
        saved_query(warehouse, name).createOrReplaceTempView(name)
        names.append(name)
    return names


# ---- exposures: report marts over the facts and dimensions ----------------
def revenue_dashboard(w) -> DataFrame:
    """Weekly revenue, orders, AOV, return rate and on-time share of the stored fact."""
    f = w.mart("fct_orders").select("order_date_day", "order_id", "total_amount", "is_returned", "is_on_time")
    g = f.groupBy(trunc_date("week", F.col("order_date_day")).alias("week_start_date")).agg(
        F.count("order_id").alias("orders"), F.sum("total_amount").alias("revenue"),
        F.sum(F.when(F.col("is_returned"), 1).otherwise(0)).alias("returned_orders"),
        F.count(F.when(F.col("is_on_time"), 1)).alias("on_time"),
        F.count("is_on_time").alias("delivered"))
    return g.select("week_start_date", "orders", "revenue",
                    (F.col("revenue").cast("double") / F.nullif(F.col("orders").cast("double"), F.lit(0.0))).alias("aov"),
                    (F.col("returned_orders").cast("double") / F.nullif(F.col("orders").cast("double"), F.lit(0.0)))
                    .alias("return_rate"),
                    (F.col("on_time").cast("double") / F.nullif(F.col("delivered").cast("double"), F.lit(0.0)))
                    .alias("on_time_share"))


def payment_health(w) -> DataFrame:
    """Authorization rate, capture latency, failures and refunds by customer segment."""
    p = w.mart("fct_payments").select("customer_id", "payment_id", "authorization_date", "hours_to_capture",
                              "is_failed", "is_refunded", "payment_amount")
    c = w.mart("dim_customers").select("customer_id", "customer_segment")
    g = p.join(c, "customer_id", "left").groupBy("customer_segment").agg(
        F.count("payment_id").alias("payments"),
        F.count("authorization_date").alias("authorized"),
        F.sum("hours_to_capture").alias("capture_hours"), F.count("hours_to_capture").alias("captured"),
        F.count(F.when(F.col("is_failed"), 1)).alias("failures"),
        F.count(F.when(F.col("is_refunded"), 1)).alias("refunds"),
        F.sum(F.when(F.col("is_refunded"), F.col("payment_amount"))).alias("refunded_amount"))
    return g.select("customer_segment", "payments",
                    (F.col("authorized").cast("double") / F.nullif(F.col("payments").cast("double"), F.lit(0.0)))
                    .alias("authorization_rate"),
                    (F.col("capture_hours").cast("double") / F.nullif(F.col("captured").cast("double"), F.lit(0.0)))
                    .alias("avg_hours_to_capture"),
                    "failures", "refunds", "refunded_amount")


def return_rate_by_segment(w) -> DataFrame:
    return SemanticLayer(w).query(["return_rate", "returned_orders", "order_count"],
                                  ["customer__customer_segment"])
