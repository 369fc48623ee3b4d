"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerloom.plans.catalog import queries
from ledgerloom.session import local_session

HEADLINE = [
    "stg_subscriptions",
    "stg_payments",
    "stg_payouts",
    "stg_unmatched_events",
    "raw_event_ids",
    "ledger_entries",
    "mart_daily_financials",
    "brand_month_mrr",
    "mrr_waterfall",
    "mrr_continuity_violations",
    "check_gmv_completeness",
    "check_no_test_in_mart",
    "monthly_financials",
    "net_revenue_retention",
    "cohort_matrix",
    "anomaly_profile",
    "fee_audit",
    "load_raw",
    "load_raw_multiline",
    "subscription_source_arrays",
    "stage_row_counts",
    "audit_not_null",
    "audit_domain",
    "audit_unique",
    "audit_unique_bitmaps",
    "audit_foreign_keys_bitmaps",
    "audit_length",
    "audit_foreign_keys",
    "validation_report",
    "audit_observed",
    "ledger_entry_ids",
    "insert_absent_days",
    "refresh_daily_financials",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    catalog, seconds = queries(), {}
    # Load Spark's join, window and aggregate code before timing.
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    orders.createOrReplaceTempView("o")
    spark.sql(
        """SELECT c, count(*), max(r) FROM (SELECT o_custkey AS c, row_number() OVER
        (PARTITION BY o_custkey ORDER BY o_orderdate) AS r FROM o) JOIN o ON c = o_custkey GROUP BY c"""
    ).write.format("noop").mode("overwrite").save()
    for name in sys.argv[1:] or HEADLINE:
        # The second run counts: the first loads and compiles what the query needs.
        catalog[name](spark, folder).write.format("noop").mode("overwrite").save()
        start = time.perf_counter()
        # Every row and column is computed; nothing is kept or sent to Python.
        catalog[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
