"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the folder of the given tables, BENCH_CPUS the local cores and
BENCH_RUNS the timed runs per query (the median counts, after one warm-up run).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.catalog import QUERIES  # noqa: E402
from tidemark.session import local_session  # noqa: E402

HEADLINE = (
    "dim_customers", "fact_orders", "rpt_monthly_revenue", "top_customers_by_ltv", "dim_employees",
    "rpt_headcount_by_dept", "salary_distribution", "fact_ad_spend", "rpt_campaign_performance",
    "rpt_customer_acquisition_cohorts", "fact_stock_movements", "rpt_current_stock_levels", "stock_running_balance",
    "rpt_inventory_reorder_alerts", "gen_order_attribution", "range_join_attribution", "metric_by_segment",
    "campaigns_snapshot", "incremental_stock_movements", "dq_not_null",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in names:
        seconds = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(seconds[1:]), 3)
        print(f"{name}: {timings[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
                "queries": timings, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
