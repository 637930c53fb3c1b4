"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is executed to completion with the ``noop`` sink (all rows are
produced, nothing is collected to the driver); the reported time is the
median of BENCH_RUNS runs after one warm-up.  ``load_sources`` (deriving
and writing the eight retail source tables once) is timed separately.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "stg_orders", "int_orders_enriched", "fct_orders", "fct_payments", "fct_returns", "dim_customers",
    "dim_products", "metric_weekly_revenue_by_segment", "metric_revenue_wow", "metric_cumulative_revenue",
    "revenue_dashboard", "payment_health", "order_economics", "product_pareto", "category_revenue",
    "dq_order_totals", "dq_relationships", "dq_event_monotonic", "latest_order_state",
]
#: Marts that metrics and reports read: storing them counts as loading.
MARTS = ["fct_orders", "fct_payments", "dim_customers"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from quayside.registry import queries
    from quayside.session import build_session
    from quayside.sources.loader import load_sources

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus)
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="quayside-bench-"))
    qs = queries()

    t0 = time.time()
    load_sources(spark, sf_dir)
    from quayside.plans.warehouse import Warehouse
    for mart in MARTS:
        Warehouse(spark, sf_dir).mart(mart)
    load_s = time.time() - t0

    results = {}
    for key in HEADLINE:
        times = []
        for i in range(runs + 1):
            t = time.time()
            qs[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i > 0:
                times.append(time.time() - t)
        results[key] = round(statistics.median(times), 3)
    total = round(sum(results.values()), 3)
    print(json.dumps({
        "metric": "load_plus_sum_of_median_query_seconds", "value": round(total + load_s, 3), "query_sec": total, "unit": "sec", "queries": results,
        "load_sources_sec": round(load_s, 3), "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus, "runs": runs, "spark": spark.version,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
