"""Named materialisations: models as tables and views in a catalog, by layer.

Each layer has a database: the layer's own name if one is configured, else the
target's.  Sources are stored as tables (a loaded one where it lies), staging
models are views over these, intermediate models, snapshots and marts are tables,
each made from the tables of the models it refers to.  ``build``
goes through the models in the order of what they refer to.  It keeps, for
every model, the state of its inputs when it was last built (of a source its rows
and a digest of them, of others the states of the models they refer to); a table
whose inputs are as they were is skipped, so a run without changes builds nothing.

Columns carry their descriptions as comments, which the catalog shows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.plans.staging import STAGING
from quayside.session import shared_dir, small_tasks

#: layer -> its own database name (None: the target's).
LAYERS = {"sources": "sources", "staging": "staging", "intermediate": "intermediate", "marts": "marts", "snapshots": "snapshots", "scratch": None}
TARGET = "analytics"
STATE = "model string, state string, rows long"


def database_of(layer: str, target: str = TARGET, layers: dict[str, str | None] = LAYERS) -> str:
    """The database of a layer: its own name, or the target's without one."""
    own = layers[layer]
    return target if own is None or not own.strip() else own.strip()


@dataclass(frozen=True)
class Node:
    """A model: its layer, what it refers to, and whether it is a view."""
    name: str
    layer: str
    refs: tuple
    view: bool = False


_STG = {f"stg_{t}": Node(f"stg_{t}", "staging", (t,), True) for t in STAGING}
NODES = {n.name: n for n in (
    *(Node(t, "sources", ()) for t in STAGING), *_STG.values(),
    Node("int_orders_enriched", "intermediate", ("stg_orders", "stg_order_items", "stg_products")),
    Node("int_customer_orders", "intermediate", ("stg_orders",)),
    Node("customers_scd", "snapshots", ("stg_customers",)),
    Node("products_scd", "snapshots", ("stg_products",)),
    Node("dim_customers", "marts", ("customers_scd", "stg_addresses", "int_customer_orders")),
    Node("dim_products", "marts", ("products_scd",)),
    Node("fct_orders", "marts", ("int_orders_enriched", "stg_payments", "stg_order_events")),
    Node("fct_payments", "marts", ("stg_payments", "stg_orders")),
    Node("fct_returns", "marts", ("fct_orders", "stg_order_events")),
)}

#: What columns mean, by model (fixed texts).
DESCRIPTIONS = {
    "dim_customers": {
        "customer_id": "Key of the customer.", "cohort_month": "Month of registration, yyyy-MM.",
        "lifetime_order_count": "Orders in any state; 0 without orders.", "lifetime_spend": "Sum of order totals in any state.",
        "return_rate": "Returned orders over all orders; 0 without orders.", "is_active": "Ordered within 365 days before the report date.",
        "customer_segment": "never_ordered, one_time, repeat (2 to 4 orders) or loyal."},
    "dim_products": {
        "product_id": "Key of the product.", "gross_margin_amount": "Price less cost.",
        "gross_margin_pct": "Margin over price; NULL for a price of 0.", "price_band": "budget, mid_range, premium or luxury, by price."},
    "fct_orders": {
        "order_id": "Key of the order.", "customer_id": "The customer who ordered.", "order_date_day": "Day of the order (UTC).",
        "gross_revenue": "Sum of the order's line totals.", "gross_margin": "Quantity times price less cost, summed over lines.",
        "has_discrepancy": "Payment and order total differ by more than a cent.", "is_on_time": "Delivered within 7 days; NULL before delivery.",
        "is_stuck": "Left without progress by the source system.", "is_returned": "The order came back."},
    "fct_payments": {
        "payment_id": "Key of the payment.", "order_id": "The order that is paid.", "hours_to_authorize": "From payment to authorisation.",
        "hours_to_capture": "From authorisation to capture.", "is_failed": "The payment failed for good."},
    "fct_returns": {
        "order_id": "Key of the returned order.", "refund_amount": "What was paid for the order.", "days_to_return": "From order to return."},
}


def described(df: DataFrame, model: str) -> DataFrame:
    """``df`` with its columns' descriptions as comments; writing keeps them."""
    about = DESCRIPTIONS.get(model, {})
    unknown = [c for c in about if c not in df.columns]
    if unknown:
        raise ValueError(f"{model} has no columns {unknown}")
    for c, text in about.items():
        df = df.withMetadata(c, {"comment": text})
    return df


def in_order(nodes: dict[str, Node] = NODES) -> list[Node]:
    """Every model after all it refers to; a circle raises."""
    done: list[Node] = []

    def visit(name: str, above: tuple) -> None:
        if name in above:
            raise ValueError(f"models refer to each other: {' -> '.join((*above, name))}")
        if name not in nodes:
            raise ValueError(f"{above[-1]} refers to {name}, which isn't a model")
        if nodes[name] in done:
            return
        for r in nodes[name].refs:
            visit(r, (*above, name))
        done.append(nodes[name])

    for n in nodes:
        visit(n, ())
    return done


class Catalog:
    """The databases of one target under the shared folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        self.root = f"{shared_dir(spark)}/{name}"
        self.made: dict[str, str] = {}

    def database(self, layer: str) -> str:
        """The layer's database, made when first asked for; its name is the target's
        name and the layer's, so that several targets live in one catalog."""
        db = f"{self.name}_{database_of(layer, self.name)}"
        if layer not in self.made:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{self.root}/{db}'")
            self.made[layer] = db
        return self.made[layer]

    def place(self, node: Node) -> str:
        return f"`{self.database(node.layer)}`.`{node.name}`"

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self.place(NODES[name]))

    def rows_of(self, name: str) -> DataFrame:
        """A model's table without its comments, which are its own."""
        df = self.table(name)
        return df.select([F.col(c).alias(c, metadata={}) for c in df.columns])

    def states(self) -> dict[str, tuple[str, int]]:
        try:
            rows = self.spark.read.schema(STATE).parquet(f"{self.root}/states").collect()     # a row for each model
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        return {r.model: (r.state, r.rows) for r in rows}

    def keep(self, states: dict[str, tuple[str, int]]) -> None:
        rows = [(m, s, n) for m, (s, n) in sorted(states.items())]
        (self.spark.createDataFrame(rows, STATE).coalesce(1).write.mode("overwrite")
         .option("partitionOverwriteMode", "static").parquet(f"{self.root}/states"))


def source_state(df: DataFrame) -> tuple[str, int]:
    """Rows of a source and a digest of all of them that their order doesn't change."""
    h = F.xxhash64(*df.columns)
    n, total, mixed = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)), F.coalesce(F.bit_xor(h), F.lit(0))).first()
    return f"{n}-{total}-{mixed}", n


def model(catalog: Catalog, warehouse, name: str) -> DataFrame:
    """A model, from the tables of the models it refers to where these are stored:
    what they hold is neither joined nor shuffled a second time."""
    if name == "dim_customers":
        return warehouse.build_dim_customers(catalog.rows_of("customers_scd"), catalog.rows_of("int_customer_orders"))
    if name == "dim_products":
        return warehouse.build_dim_products(catalog.rows_of("products_scd"))
    if name == "fct_orders":
        return warehouse.build_fct_orders(catalog.rows_of("int_orders_enriched"))
    if name == "fct_returns":
        return warehouse.build_fct_returns(catalog.rows_of("fct_orders"))
    return getattr(warehouse, name)


def store(catalog: Catalog, warehouse, node: Node, df: DataFrame) -> None:
    """A model's table, written by tasks of bounded size; a source that is already
    stored becomes a table where it lies."""
    spark, name = catalog.spark, f"{catalog.database(node.layer)}.{node.name}"
    at = None if node.refs else warehouse.stored_at(node.name)
    if at is not None:
        spark.sql(f"DROP TABLE IF EXISTS {catalog.place(node)}")
        spark.catalog.createTable(name, path=at, source="parquet", schema=described(df, node.name).schema)
        return
    with small_tasks(spark, warehouse.input_bytes):
        described(df, node.name).write.mode("overwrite").format("parquet").option("compression", "zstd").saveAsTable(name)


def build(catalog: Catalog, warehouse) -> list[tuple[str, str, str, str, int]]:
    """One run over all models: ``(model, database, kind, action, rows)``, the
    action ``built`` or ``skipped`` (a view is only ever replaced)."""
    spark, before, now, log = catalog.spark, catalog.states(), {}, []
    for node in in_order():
        place, db = catalog.place(node), catalog.database(node.layer)
        if not node.refs:
            df = warehouse.source(node.name)
            state, rows = source_state(df)
        else:
            df, rows = None, None
            state = hashlib.sha256("|".join(now[r][0] for r in node.refs).encode()).hexdigest()
        if node.view:
            cols = ", ".join(f"`{c}`" if isinstance(c, str) else f"`{c[0]}` AS `{c[1]}`" for c in STAGING[node.refs[0]])
            spark.sql(f"CREATE OR REPLACE VIEW {place} AS SELECT {cols} FROM {catalog.place(NODES[node.refs[0]])}")
            now[node.name] = state, now[node.refs[0]][1]
            log.append((node.name, db, "view", "built", now[node.name][1]))
            continue
        if before.get(node.name, ("",))[0] == state and spark.catalog.tableExists(f"{db}.{node.name}"):
            now[node.name] = before[node.name]
            log.append((node.name, db, "table", "skipped", now[node.name][1]))
            continue
        store(catalog, warehouse, node, df if df is not None else model(catalog, warehouse, node.name))
        now[node.name] = state, rows if rows is not None else spark.table(place).count()
        log.append((node.name, db, "table", "built", now[node.name][1]))
        catalog.keep({**before, **now})         # a run that stops goes on from here
    catalog.keep(now)
    return log


def descriptions(catalog: Catalog) -> DataFrame:
    """``(model, column_name, description)`` of every described column, read back from the catalog."""
    rows = []
    for node in NODES.values():
        if node.name in DESCRIPTIONS:
            rows += [(node.name, f.name, f.metadata["comment"]) for f in catalog.table(node.name).schema.fields if f.metadata.get("comment")]
    return catalog.spark.createDataFrame(rows, "model string, column_name string, description string")
