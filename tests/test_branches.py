import threading
import time

import pytest
from pyspark.sql import functions as F

from ledgerloom.branches import run_together
from ledgerloom.operators import audits
from ledgerloom.sources.tables import RunFolder


def slow(x):
    time.sleep(0.2)
    return x


def running(spark):
    return list(spark.sparkContext.statusTracker().getActiveJobsIds())


def test_results_by_name_and_side_by_side(spark):
    met = threading.Barrier(3, timeout=60)  # none of the branches ends before all have begun

    def branch(n):
        met.wait()
        return spark.range(n).count()

    assert run_together(spark, {f"b{n}": lambda n=n: branch(n) for n in range(3)}) == {"b0": 0, "b1": 1, "b2": 2}
    assert run_together(spark, {}) == {}


def test_a_failing_branch_leaves_no_running_job(spark):
    rows = spark.range(0, 400, 1, 400).select(F.udf(slow, "long")("id").alias("x"))
    begun, after = threading.Event(), []

    def endless():
        begun.set()
        rows.agg(F.sum("x")).collect()
        after.append("went on")

    def failing():
        begun.wait(60)
        while not running(spark):
            time.sleep(0.05)
        raise ValueError("stopped")

    start = time.time()
    with pytest.raises(ValueError, match="stopped"):
        run_together(spark, {"endless": endless, "failing": failing})
    assert time.time() - start < 15 and after == []
    deadline = time.time() + 10
    while running(spark) and time.time() < deadline:
        time.sleep(0.1)
    assert running(spark) == []


def test_figures_are_gathered_while_a_table_is_written(spark, tmp_path):
    run = RunFolder(spark, str(tmp_path))
    brands = spark.createDataFrame(
        [(1, "BRD-1", "a", "x", "SMB", None), (2, "BRD-" + "2" * 30, None, "x", "Huge", None), (3, None, "c", None, None, None)],
        "brand_id int, brand_external_id string, brand_name string, industry string, tier string, created_at timestamp",
    )
    stored = run.keep("dim_brand", brands, audits.rule_counts("dim_brand"))
    assert stored.count() == 3
    seen = run.figures["dim_brand"]
    assert seen["rows"] == 3 and seen["not_null:created_at"] == 3 and seen["not_null:brand_id"] == 0
    assert seen["domain:tier"] == 1 and seen["length:brand_external_id"] == 1
    run.keep("nothing", brands.limit(0), audits.rule_counts("dim_brand"))
    assert set(run.figures["nothing"].values()) == {0}


def test_as_many_rules_as_the_data_model_has():
    # Written out: a rule left out of the audit must not be left out of its check.
    assert {t: len(c) for t, c in audits.NOT_NULL.items()} == {
        "dim_date": 9, "dim_brand": 6, "dim_creator": 6, "raw_subscription_events": 7, "raw_campaigns": 6, "raw_payments": 7,
        "raw_payouts": 6, "stg_subscriptions": 6, "stg_subscription_source_arrays": 3, "stg_unmatched_events": 5,
        "stg_ledger_entries": 5, "mart_daily_financials": 7, "mart_monthly_subscriptions": 8,
    }
    assert {t: len(k) for t, k in audits.UNIQUE.items()} == {
        "dim_date": 1, "dim_brand": 2, "dim_creator": 2, "raw_subscription_events": 1, "raw_campaigns": 1, "raw_payments": 1,
        "raw_payouts": 1, "stg_subscriptions": 1, "stg_subscription_source_arrays": 1, "stg_unmatched_events": 1,
        "stg_ledger_entries": 1, "mart_daily_financials": 1, "mart_monthly_subscriptions": 1,
    }
    assert sum(len(rules) for rules in audits.DOMAINS.values()) == 15
    assert len(audits.FOREIGN_KEYS) == 7 and len(audits.LENGTHS) == 2
