"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the sample directory, ``BENCH_CPUS`` the number of cores,
``BENCH_QUERIES`` (optional, comma separated) the queries, ``BENCH_RUNS`` the repeats. Each
query runs once to warm up; the figure is the median of the runs after that. Results go to
Spark's ``noop`` sink, so every row and column is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from bazaarline.session import local_session
from parity.queries import REGISTRY

HEADLINE = (
    "stg_order_reviews",
    "dedup_latest",
    "order_items_agg",
    "order_payments_agg",
    "dim_products",
    "fct_order_items",
    "order_revenue",
    "seller_order_detail",
    "seller_performance",
    "seller_performance_reconciled",
    "customer_segmentation",
    "orders_status_snapshot",
    "scd2_second_run",
    "avg_time_per_status",
    "customer_order_dates",
    "densify_calendar",
    "category_gmv",
    "product_performance",
    "weight_delivery_corr",
    "metric_seller_rollup",
    "dq_unique",
    "dq_not_null",
    "dq_accepted_values",
    "dq_orphans",
    "dq_reconcile",
    "dq_row_count_match",
    "dq_freshness",
    "dq_share_threshold",
)


def seconds(spark, sf_dir: str, name: str) -> float:
    started = time.perf_counter()
    REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session("bench", cpus)
    timings = {}
    for name in names:
        seconds(spark, sf_dir, name)
        timings[name] = round(statistics.median(seconds(spark, sf_dir, name) for _ in range(runs)), 3)
    result = {
        "metric": "total_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
        "runs": runs,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
