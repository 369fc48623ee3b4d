"""Unique and foreign key audits of integer keys by bitmaps, against counts by key."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import audits


def both(df):
    return tuple(audits.number_repeats(df, "k").first()), tuple(audits._repeats(df, ("k",)).first())


@pytest.mark.parametrize(
    "keys",
    [
        [],
        [None],
        [None, None, None, 5],
        [0, -1, 1, 32_767, 32_768, 32_769, -32_768, -32_769],
        [2**63 - 1, -(2**63), -(2**63), 2**63 - 1, 0, 0, -1, -1],
        list(range(70_000)) + [3, 3, 69_999],
    ],
)
def test_given_keys(spark, keys):
    found, wanted = both(spark.createDataFrame([(k,) for k in keys], "k long"))
    assert found == wanted


def test_random_keys_in_several_tasks(spark):
    draw = random.Random(5)
    keys = [(draw.choice([None, draw.randint(-50_000, 50_000), draw.randint(0, 9)]),) for _ in range(20_000)]
    found, wanted = both(spark.createDataFrame(keys, "k long").repartition(7))
    assert found == wanted and found[1] > 100


def test_smaller_integers_and_a_hot_key(spark):
    df = spark.range(100_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("int").alias("k"))
    found, wanted = both(df)
    assert found == wanted == (100_000, 1, 33_334)


def test_only_bitmaps_are_shuffled(spark, tmp_path):
    path = str(tmp_path / "numbers")
    spark.range(0, 1_000_000, 1, 4).select(F.col("id").alias("k")).write.parquet(path)
    spark.sparkContext.setJobGroup("bitmaps", "bitmaps")
    try:
        assert tuple(audits.number_repeats(spark.read.parquet(path), "k").first()) == (1_000_000, 0, 0)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    store = spark.sparkContext._jsc.sc().statusStore()
    tracker = spark.sparkContext.statusTracker()
    stages = {s for job in tracker.getJobIdsForGroup("bitmaps") for s in tracker.getJobInfo(job).stageIds}
    moved = sum(store.lastStageAttempt(s).shuffleWriteRecords() for s in stages if tracker.getStageInfo(s))
    assert 0 < moved < 10_000


@pytest.mark.parametrize(
    "named, known",
    [
        ([], []),
        ([None, 1, 1, 2], []),
        ([], [1, 2]),
        ([5, 5, None, -3, 2**63 - 1, -(2**63), 0], [0, 5, None, 32_768]),
        (list(range(0, 200_000, 3)) * 2, list(range(0, 200_000, 2))),
    ],
)
def test_missing_numbers(spark, named, known):
    sides = [spark.createDataFrame([(k,) for k in keys], "key long").repartition(3) for keys in (named, known)]
    assert tuple(audits.number_orphans(*sides).first()) == tuple(audits._orphans(*sides).first())


def test_every_rule_is_audited():
    """How many rules each table has, written out, since the SQL takes the rules from the library."""
    assert {t: len(c) for t, c in audits.NOT_NULL.items()} == {
        "dim_date": 9, "dim_brand": 6, "dim_creator": 6, "raw_subscription_events": 7, "raw_campaigns": 6, "raw_payments": 7,
        "raw_payouts": 6, "stg_subscriptions": 6, "stg_subscription_source_arrays": 3, "stg_unmatched_events": 5,
        "stg_ledger_entries": 5, "mart_daily_financials": 7, "mart_monthly_subscriptions": 8,
    }
    assert {t: sorted(r) for t, r in audits.DOMAINS.items()} == {
        "dim_brand": ["tier"], "dim_creator": ["follower_tier"], "raw_subscription_events": ["amount_cents", "billing_period", "event_type"],
        "raw_campaigns": ["agreed_budget_cents", "status"],
        "raw_payments": ["amount_gross_cents", "amount_refunded_cents", "platform_fee_cents", "stripe_fee_cents"],
        "raw_payouts": ["amount_paid_cents", "status"], "stg_subscriptions": ["mrr_cents"], "stg_ledger_entries": ["entry_type"],
    }
    assert sum(len(k) for k in audits.UNIQUE.values()) == 15
    assert len(audits.FOREIGN_KEYS) == 7 and len(audits.LENGTHS) == 2
