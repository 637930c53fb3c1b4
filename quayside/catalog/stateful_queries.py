"""Registered multi-run (stateful) queries: incremental models, SCD2
snapshots, insert-if-absent, column sync, change gate, schema drift.

Each query really runs the job several times against tables written to
the shared folder (write-then-switch: every run writes a new location and
the next run reads it), and returns the final table.  The oracle is the
single full build the runs must converge to.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.oracle import models_sql  # noqa: F401
from quayside.oracle.ctes import with_ctes
from quayside.operators.scd2 import scd2_append, scd2_history
from quayside.operators.upsert import (insert_ignore, read_partitioned, sync_columns, upsert, upsert_partitions,
                                       write_partitioned)
from quayside.plans import materialize
from quayside.plans.analytics import Analytics, sketch_error
from quayside.plans.warehouse import Warehouse
from quayside.registry import register
from quayside.session import scratch_path
from quayside.sources import schemas as S

CUTOFF = _dt.datetime(1998, 1, 1)
SCD_RUNS = (_dt.datetime(2024, 1, 1), _dt.datetime(2024, 2, 1), _dt.datetime(2024, 3, 1))
LOOKBACK_DAYS = 3


def _persist(spark, df, name):
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _first_run_warehouse(spark, sf_dir):
    """The sources as an earlier run saw them: orders, payments and events from
    before the cut only, every seventh of the kept orders still in its first
    state with another total, every fifth kept payment with another amount."""
    w, cut = Warehouse(spark, sf_dir), F.lit(CUTOFF)
    k = F.col("order_id").cast("long")
    late = F.col("updated_at") >= cut
    # a changed row changed after the cut, which is what makes it new to run 2
    orders = w.source("orders").filter(F.col("order_date") < cut)
    orders = (orders.withColumn("order_state", F.when(late, F.lit("placed")).otherwise(F.col("order_state")))
              .withColumn("total_amount", F.when(late & (k % 7 == 0), F.col("total_amount") + 5).otherwise(F.col("total_amount"))
                          .cast("decimal(12,2)"))
              .withColumn("updated_at", F.when(late, F.col("order_date")).otherwise(F.col("updated_at"))))
    changed = _payment_changed_at() >= cut
    payments = w.source("payments").filter(F.col("payment_date") < cut)
    payments = (payments.withColumn("amount", F.when(changed & (k % 5 == 0), F.col("amount") + 9).otherwise(F.col("amount"))
                                    .cast("decimal(12,2)"))
                .withColumn("payment_state", F.when(changed, F.lit("pending")).otherwise(F.col("payment_state")))
                .withColumns({c: F.when(F.col(c) < cut, F.col(c)) for c in ("authorization_date", "capture_date", "refund_date")}))
    events = w.source("order_events").filter(F.col("event_timestamp") < cut)
    return Warehouse(spark, sf_dir, sources={"orders": orders, "payments": payments, "order_events": events})


def _payment_changed_at():
    floor = F.lit("1900-01-01").cast("timestamp")
    return F.greatest(*[F.coalesce(F.col(c), floor) for c in (
        "payment_date", "authorization_date", "capture_date", "refund_date")])


def _changed_orders(w, since):
    """Ids of orders that changed themselves, by a payment or by an event."""
    since = F.lit(since - _dt.timedelta(days=LOOKBACK_DAYS))
    ids = [w.stg_orders.filter(F.greatest("updated_at", "order_date") >= since).select("order_id"),
           w.stg_payments.filter(_payment_changed_at() >= since).select("order_id"),
           w.stg_order_events.filter(F.col("event_timestamp") >= since).select("order_id")]
    return reduce(DataFrame.unionByName, ids).distinct()


MONTH = "__month"


def _by_month(df):
    """A fact with the month it is stored by."""
    return df.withColumn(MONTH, F.date_format("order_date_day", "yyyy-MM"))


def _runs(spark, sf_dir, name, key, first, delta):
    """Run 1 on the earlier sources, then two runs on the present ones; the
    second must change nothing.  Each delta is written once, as it is used twice,
    and only the months it touches are written again."""
    fact = _by_month(first(_first_run_warehouse(spark, sf_dir)))
    path = scratch_path(spark, f"{name}-by-month")
    write_partitioned(fact, path, MONTH)
    w, since = Warehouse(spark, sf_dir), CUTOFF
    for run in (2, 3):
        new = _persist(spark, _by_month(delta(w, _changed_orders(w, since))), f"{name}-delta{run}")
        upsert_partitions(spark, path, new, [key], MONTH, moves=False)      # an order's date never changes
        since = w.stg_order_events.agg(F.max("event_timestamp")).first()[0] or since
    return read_partitioned(spark, path, fact.schema).drop(MONTH)


def _delta_orders(w, ids):
    return w.build_fct_orders(w.enriched_of(w.stg_orders.join(ids, "order_id", "left_semi")))


@register("incremental_fct_orders", with_ctes("SELECT * FROM fct_orders", "fct_orders"))
def incremental_fct_orders(spark, sf_dir):
    return _runs(spark, sf_dir, "fct_orders", "order_id", lambda w: w.fct_orders, _delta_orders)


@register("incremental_fct_payments", with_ctes("SELECT * FROM fct_payments", "fct_payments"))
def incremental_fct_payments(spark, sf_dir):
    return _runs(spark, sf_dir, "fct_payments", "payment_id", lambda w: w.fct_payments,
                 lambda w, ids: w.build_fct_payments(w.stg_payments.join(ids, "order_id", "left_semi")))


@register("incremental_fct_returns", with_ctes("SELECT * FROM fct_returns", "fct_returns"))
def incremental_fct_returns(spark, sf_dir):
    return _runs(spark, sf_dir, "fct_returns", "order_id", lambda w: w.fct_returns,
                 lambda w, ids: w.build_fct_returns(_delta_orders(w, ids).filter("is_returned")))


# ---- SCD2 two-version fixtures -------------------------------------------
def _scd_oracle(stg, key, changed_sql, new_cols_sql):
    t1, t2 = (f"TIMESTAMP '{t:%Y-%m-%d %H:%M:%S}'" for t in SCD_RUNS[:2])
    sid = lambda t: f"md5({key} || '|' || strftime({t}, '%Y-%m-%d %H:%M:%S'))"
    return with_ctes(f"""
SELECT *, {t1} AS valid_from, CASE WHEN {changed_sql} THEN {t2} END AS valid_to, {sid(t1)} AS scd_id FROM {stg}
UNION ALL
SELECT {new_cols_sql}, {t2} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, {sid(t2)} AS scd_id
FROM {stg} WHERE {changed_sql}""", stg)


_CK = "CAST(customer_id AS BIGINT)"
_PK = "CAST(product_id AS BIGINT)"
SCD_CUSTOMERS_SQL = _scd_oracle(
    "stg_customers", "customer_id", f"{_CK} % 10 = 0 AND {_CK} % 97 <> 0",
    "customer_id, first_name, last_name, 'v2.' || email AS email, address_id, created_at")
SCD_PRODUCTS_SQL = _scd_oracle(
    "stg_products", "product_id", f"{_PK} % 10 = 0 AND {_PK} % 97 <> 0",
    "product_id, sku, product_name, product_category, CAST(unit_price + 10 AS DECIMAL(12,2)) AS unit_price, cost_price")


def _scd_runs(spark, v1, v2, key, check_cols, name):
    path = scratch_path(spark, name)
    for src, ts in zip((v1, v2, v2), SCD_RUNS, strict=True):
        scd2_append(spark, path, src, key, check_cols, ts)
    return scd2_history(spark, path, v1.schema)


@register("scd2_customers", SCD_CUSTOMERS_SQL)
def scd2_customers(spark, sf_dir):
    c = Warehouse(spark, sf_dir).stg_customers
    k = F.col("customer_id").cast("long")
    v2 = (c.filter(k % 97 != 0)
          .withColumn("email", F.when(k % 10 == 0, F.concat(F.lit("v2."), F.col("email")))
                      .otherwise(F.col("email"))))
    return _scd_runs(spark, c, v2, "customer_id", Warehouse.CUSTOMER_CHECK, "customers_scd")


@register("scd2_products", SCD_PRODUCTS_SQL)
def scd2_products(spark, sf_dir):
    p = Warehouse(spark, sf_dir).stg_products
    k = F.col("product_id").cast("long")
    v2 = (p.filter(k % 97 != 0)
          .withColumn("unit_price", F.when(k % 10 == 0, F.col("unit_price") + 10)
                      .otherwise(F.col("unit_price")).cast(S.MONEY)))
    return _scd_runs(spark, p, v2, "product_id", Warehouse.PRODUCT_CHECK, "products_scd")


# ---- insert-if-absent, column sync, change gate, schema drift ------------
@register("insert_ignore", with_ctes("SELECT * FROM stg_customers", "stg_customers"))
def insert_ignore_query(spark, sf_dir):
    """Seed two thirds of the customers, then replay a delta holding every
    customer plus a conflicting copy of the new ones: existing keys are
    ignored, the first copy (by column order) of a new key wins."""
    c = Warehouse(spark, sf_dir).stg_customers
    k = F.col("customer_id").cast("long")
    seed = _persist(spark, c.filter(k % 3 != 0), "customers-seed")
    dup = c.filter(k % 3 == 0).withColumn("first_name", F.lit("dup"))
    return insert_ignore(seed, c.unionByName(dup), ["customer_id"])


_SYNC_CUT = "1998-01-01"


@register("schema_sync", with_ctes(f"""
SELECT * REPLACE (CASE WHEN order_date < TIMESTAMP '{_SYNC_CUT} 00:00:00' THEN NULL ELSE is_stuck END AS is_stuck)
FROM fct_orders""", "fct_orders"))
def schema_sync(spark, sf_dir):
    """Old target lacks ``is_stuck`` and carries an obsolete column; the new
    batch has the current columns.  sync_all_columns: add the new column
    (NULL for old rows), drop the removed one, then merge by key."""
    f = Warehouse(spark, sf_dir).fct_orders
    cut = F.lit(_SYNC_CUT).cast("timestamp")
    old = _persist(spark, f.filter(F.col("order_date") < cut).drop("is_stuck")
                   .withColumn("legacy_flag", F.lit(True)), "fct_orders-old-schema")
    new = f.filter(F.col("order_date") >= cut)
    synced = sync_columns(old, new.limit(0), "sync_all_columns")
    return upsert(synced, new, ["order_id"])


@register("schema_widen", with_ctes(f"""
SELECT order_id, line_count, total_amount,
       CASE WHEN order_date < TIMESTAMP '{_SYNC_CUT} 00:00:00' THEN CAST(CAST(order_date AS DATE) AS TIMESTAMP) ELSE order_date END AS order_date
FROM fct_orders""", "fct_orders"))
def schema_widen(spark, sf_dir):
    """An old target with narrower columns (int, a shorter decimal, a date) takes
    the wider types of the new batch."""
    f = Warehouse(spark, sf_dir).fct_orders.select("order_id", "line_count", "total_amount", "order_date")
    cut = F.lit(_SYNC_CUT).cast("timestamp")
    old = _persist(spark, f.filter(F.col("order_date") < cut).select(
        "order_id", F.col("line_count").cast("int").alias("line_count"), F.col("total_amount").cast("decimal(10,2)").alias("total_amount"),
        F.col("order_date").cast("date").alias("order_date")), "fct_orders-narrow")
    new = f.filter(F.col("order_date") >= cut)
    return upsert(sync_columns(old, new.limit(0)), new, ["order_id"])


@register("change_gate", with_ctes(f"""
SELECT 'orders' AS table_name, p.rows AS prev_rows, p.max_updated_at AS prev_max_updated_at,
       c.rows AS cur_rows, c.max_updated_at AS cur_max_updated_at,
       CASE WHEN p.rows = c.rows AND p.max_updated_at IS NOT DISTINCT FROM c.max_updated_at
            THEN 'skip' ELSE 'run' END AS decision
FROM (SELECT count(*) AS rows, max(updated_at) AS max_updated_at FROM stg_orders
      WHERE updated_at < TIMESTAMP '{CUTOFF:%Y-%m-%d %H:%M:%S}') p,
     (SELECT count(*) AS rows, max(updated_at) AS max_updated_at FROM stg_orders) c""", "stg_orders"))
def change_gate(spark, sf_dir):
    """Skip downstream work when the source is unchanged since the last run
    (row count and high-water mark, both computed by Spark)."""
    o = Warehouse(spark, sf_dir).stg_orders

    def state(df):
        return df.agg(F.count(F.lit(1)).alias("rows"), F.max("updated_at").alias("max_updated_at"))
    prev = state(o.filter(F.col("updated_at") < F.lit(CUTOFF)))
    cur = state(o)
    j = prev.select(F.col("rows").alias("prev_rows"), F.col("max_updated_at").alias("prev_max_updated_at")) \
        .crossJoin(cur.select(F.col("rows").alias("cur_rows"), F.col("max_updated_at").alias("cur_max_updated_at")))
    same = (F.col("prev_rows") == F.col("cur_rows")) & F.col("prev_max_updated_at").eqNullSafe(
        F.col("cur_max_updated_at"))
    return j.select(F.lit("orders").alias("table_name"), "*",
                    F.when(same, "skip").otherwise("run").alias("decision"))


def _drift_sql():
    return with_ctes("""
SELECT 'orders' AS table_name, 'first_event_at' AS column_name, 'missing_in_warehouse' AS change,
       'timestamp' AS source_type, CAST(NULL AS VARCHAR) AS warehouse_type,
       count(first_event_at) AS non_null_values
FROM raw_orders""", "raw_orders")


@register("schema_drift", _drift_sql())
def schema_drift(spark, sf_dir):
    """Columns whose source and warehouse declarations differ, with the
    number of values each difference affects (counted in one pass)."""
    from quayside.operators.schema_ops import schema_diff
    w = Warehouse(spark, sf_dir)
    frames = []
    for table, declared in S.SOURCE_SCHEMAS.items():
        src = w.source(table)
        wh_cols = S.WAREHOUSE_ORDER_COLUMNS if table == "orders" else [f.name for f in declared.fields]
        warehouse = S.T.StructType([f for f in declared.fields if f.name in wh_cols])
        diffs = schema_diff(warehouse, src.schema)
        if not diffs:
            continue
        frames.append(src.agg(*[F.count(F.col(d["column_name"])).alias(f"n{i}") for i, d in enumerate(diffs)])
                      .select(F.explode(F.array(*[
                          F.struct(F.lit(table).alias("table_name"), F.lit(d["column_name"]).alias("column_name"),
                                   F.lit(d["change"]).alias("change"),
                                   F.lit(d["new_type"]).cast("string").alias("source_type"),
                                   F.lit(d["old_type"]).cast("string").alias("warehouse_type"),
                                   F.col(f"n{i}").alias("non_null_values"))
                          for i, d in enumerate(diffs)])).alias("d")).select("d.*"))
    from functools import reduce
    return reduce(lambda a, b: a.unionByName(b), frames)


# ---- distinct counts by sketch ---------------------------------------------
def _sketched(spark, sf_dir):
    """Daily sketches are stored, months come from merging them."""
    a = Analytics(Warehouse(spark, sf_dir))
    stored = _persist(spark, a.customer_sketches(), "customer-sketches")
    return a.distinct_exact("month").join(a.distinct_of(stored, "month"), "month", "full_outer")


@register("distinct_customers_sketch")
def distinct_customers_sketch(spark, sf_dir):
    """The estimate beside the exact count (no oracle: its hash is Spark's own)."""
    return _sketched(spark, sf_dir)


@register("distinct_customers_bound", with_ctes("""
SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, count(DISTINCT customer_id) AS exact_customers, true AS within_four_errors
FROM stg_orders GROUP BY 1""", "stg_orders"))
def distinct_customers_bound(spark, sf_dir):
    """Whether the estimate of every month lies within four standard errors (and
    one customer, where that is more)."""
    off = F.abs(F.col("estimated_customers") - F.col("exact_customers"))
    bound = F.greatest(F.lit(1.0), F.col("exact_customers") * (4 * sketch_error()))
    return _sketched(spark, sf_dir).select("month", "exact_customers", F.coalesce(off <= bound, F.lit(False)).alias("within_four_errors"))


# ---- named materialisations ------------------------------------------------
def _built(spark, sf_dir, name):
    """Three runs: the first builds all; the second, on the same sources, nothing;
    before the third the payments change."""
    w = Warehouse(spark, sf_dir)
    catalog = materialize.Catalog(spark, scratch_path(spark, name).rsplit("/", 1)[1].replace("-", "_"))
    runs = [materialize.build(catalog, w), materialize.build(catalog, w)]
    paid = w.source("payments").withColumn("retry_count", F.col("retry_count") + 1)
    runs.append(materialize.build(catalog, Warehouse(spark, sf_dir, sources={"payments": paid})))
    return catalog, runs


_LOGGED = {n.name: ("view" if n.view else "table") for n in materialize.NODES.values()}
_AFTER_PAYMENTS = ("payments", "fct_orders", "fct_payments", "fct_returns")


def _build_sql():
    def line(name, kind):
        third = "built" if kind == "view" or name in _AFTER_PAYMENTS else "skipped"
        second = "built" if kind == "view" else "skipped"
        source = name if not materialize.NODES[name].layer == "sources" else f"raw_{name}"
        return (f"SELECT '{name}' AS model, '{materialize.database_of(materialize.NODES[name].layer)}' AS database, '{kind}' AS kind, "
                f"'built' AS first_run, '{second}' AS second_run, '{third}' AS third_run, (SELECT count(*) FROM {source}) AS rows")
    names = [n if materialize.NODES[n].layer != "sources" else f"raw_{n}" for n in _LOGGED]
    return with_ctes("\nUNION ALL ".join(line(n, k) for n, k in _LOGGED.items()), *names)


@register("build_log", _build_sql())
def build_log(spark, sf_dir):
    """Every model with its database and what three runs did with it; the rows are
    counted in the catalog's table or view."""
    catalog, runs = _built(spark, sf_dir, "build")
    out = None
    for (model, db, kind, *_), actions in zip(runs[0], zip(*[[r[3] for r in run] for run in runs], strict=True), strict=True):
        row = catalog.table(model).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(model).alias("model"), F.lit(db.removeprefix(f"{catalog.name}_")).alias("database"), F.lit(kind).alias("kind"),
            *[F.lit(a).alias(f"{n}_run") for n, a in zip(("first", "second", "third"), actions, strict=True)], "rows")
        out = row if out is None else out.unionByName(row)
    return out


def _described_sql():
    rows = [(m, c, text) for m, about in materialize.DESCRIPTIONS.items() for c, text in about.items()]
    return "SELECT * FROM (VALUES " + ", ".join(f"('{m}', '{c}', '{t.replace(chr(39), chr(39) * 2)}')" for m, c, t in rows) + \
        ") t(model, column_name, description)"


@register("column_descriptions", _described_sql())
def column_descriptions(spark, sf_dir):
    """What the catalog says about the columns of the stored marts."""
    catalog = materialize.Catalog(spark, scratch_path(spark, "described").rsplit("/", 1)[1].replace("-", "_"))
    materialize.build(catalog, Warehouse(spark, sf_dir))
    return materialize.descriptions(catalog)
