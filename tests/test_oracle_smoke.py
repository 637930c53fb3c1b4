"""A few registered queries against their DuckDB oracle at sf0.001."""
import decimal

import duckdb
import pytest

from quayside.registry import oracle_sql, queries

SF = "/root/testdata/sf0.001"
KEYS = ["fct_orders", "dim_customers", "metric_weekly_revenue_by_segment", "metric_revenue_wow",
        "dq_order_totals", "product_pareto", "order_economics", "scd2_products", "cdc_merge"]


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        out.append(tuple(str(r[i].normalize()) if isinstance(r[i], decimal.Decimal) else r[i] for i in order))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    df = queries()[key](spark, SF)
    cur = con.execute(oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(cur.fetchall(), dcols)


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0 and len(e.oracle_sql()) > 0
    assert set(e.oracle_sql()) <= set(e.queries())
