"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs from the raw tables through all layers it needs, with every result
row produced (written to the no-op sink). The first run of each query is a warm-up,
the second one counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark.plans.catalog import QUERIES
from tidemark.session import get_session

HEADLINE = [
    "s1_full_extract",
    "s6_incremental_extract",
    "c4_clean_users",
    "c6_clean_orders",
    "c7_clean_order_items",
    "m3_clean_crm_sales",
    "d4_scd2_upsert",
    "d9_dim_customers",
    "f1_fact_orders",
    "f1b_fact_orders_as_of",
    "f2_fact_transactions",
    "f3_fact_sales",
    "v1_revenue_by_month_category",
    "v2_user_orders_by_city",
    "v4_top_products",
    "q1_top_customers",
    "q3_monthly_trend",
    "x3_duplicate_keys",
    "x5_dq_checks",
    "x7_constraints",
    "t1_change_stream",
]


def run(spark, folder: str, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    settings = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = get_session("bench", f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        run(spark, folder, name)
        seconds[name] = round(run(spark, folder, name), 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    report = {"metric": "headline queries, total wall time", "value": total, "unit": "sec"}
    print(json.dumps({**report, "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
