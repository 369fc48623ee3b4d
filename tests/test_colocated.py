from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from ledgerloom.session import scratch_path
from ledgerloom.sources import colocated

PAYMENTS = "payment_id long, brand_id int"
PAYOUTS = "payout_id long, payment_id long, paid long"


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def stored(spark, payments, payouts, hot_rows):
    mark = uuid.uuid4().hex
    tables = {
        f"payments_{mark}": spark.createDataFrame(payments, PAYMENTS),
        f"payouts_{mark}": spark.createDataFrame(payouts, PAYOUTS),
    }
    found = colocated.store(spark, tables, scratch_path(spark, "buckets"), "payment_id", 4, hot_rows)
    return [found[name] for name in tables]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


PAYMENT_ROWS = [(i, i % 5) for i in range(200)] + [(None, 1)]
# Payment 7 holds a third of all payouts; some payouts name no payment or one that does not exist.
PAYOUT_ROWS = [(n, n % 190, n) for n in range(400)] + [(1000 + n, 7, 1) for n in range(220)] + [(5000, None, 1), (5001, 999, 1)]


def test_no_shuffle_below_the_join_of_stored_tables(spark, no_broadcast):
    payments, payouts = stored(spark, PAYMENT_ROWS, PAYOUT_ROWS, 100)
    joined = payouts.bucketed.join(payments.bucketed, "payment_id")
    assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
    assert "Exchange" in plan(payouts.rows().join(payments.rows(), "payment_id"))


@pytest.mark.parametrize("how", ["inner", "left", "full", "left_anti", "left_semi"])
@pytest.mark.parametrize("hot_rows", [100, 1_000_000, 0])
def test_joins_of_parts_equal_the_plain_join(spark, no_broadcast, how, hot_rows):
    payments, payouts = stored(spark, PAYMENT_ROWS, PAYOUT_ROWS, hot_rows)
    whole = spark.createDataFrame(PAYOUT_ROWS, PAYOUTS).join(spark.createDataFrame(PAYMENT_ROWS, PAYMENTS), "payment_id", how)
    found = colocated.together(payouts, payments, lambda a, b: a.join(b, "payment_id", how))
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))


def test_a_hot_payment_lies_apart_in_both_tables(spark):
    payments, payouts = stored(spark, PAYMENT_ROWS, PAYOUT_ROWS, 100)
    assert {r[0] for r in payouts.apart.select("payment_id").distinct().collect()} == {7, None}
    assert sorted((r[0] or 0) for r in payments.apart.select("payment_id").collect()) == [0, 7]
    assert payouts.bucketed.where("payment_id = 7").count() == 0 and payouts.rows().count() == len(PAYOUT_ROWS)
    per_file = payouts.bucketed.select("payment_id", F.input_file_name().alias("file")).distinct()
    assert per_file.count() == per_file.select("payment_id").distinct().count() == 190  # 0 to 189 without 7, and 999


def test_empty_tables_and_names_taken_or_given_back(spark):
    payments, payouts = stored(spark, [], [], 10)
    assert colocated.together(payouts, payments, lambda a, b: a.join(b, "payment_id")).count() == 0
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        colocated.store(spark, {payments.name: spark.createDataFrame([], PAYMENTS)}, scratch_path(spark, "again"), "payment_id", 4)
    payments.forget()
    assert not spark.catalog.tableExists(payments.name) and not spark.catalog.tableExists(f"{payments.name}_apart")
