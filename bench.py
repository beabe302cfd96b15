"""Time the headline queries: one JSON line with seconds per query.

Every query runs to completion into the no-op sink, so all columns of all rows are computed. One
warm-up run, then the median of three.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerloom import build_session  # noqa: E402
from ledgerloom.plans.registry import run  # noqa: E402
from ledgerloom.sources.workspace import work_scope  # noqa: E402

HEADLINE = [
    "running_total_by_month",
    "running_total_self_join",
    "customer_total_param",
    "customer_totals_left_join",
    "monthly_sales",
    "slow_items_by_month",
    "slow_items_by_month_zero_filled",
    "big_months_zero_filled",
    "idle_salespeople_exists",
    "order_calendar",
    "order_calendar_page",
    "latest_sales",
    "top_item_cities_cte",
    "large_invoices_picked",
    "top2_items_per_month",
    "item_window_profile",
    "last_customer_per_salesperson",
    "dearest_items_dense_rank",
    "dearest_items_apply",
    "pivot_dynamic",
    "merge_customers",
    "xml_items_merge",
    "json_tag_search",
    "dq_foreign_keys",
    "dq_checks",
    "dq_keys",
]
REPEATS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        int(cpus),
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        with work_scope(spark):
            start = time.perf_counter()
            run(name, spark, folder).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(REPEATS)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
