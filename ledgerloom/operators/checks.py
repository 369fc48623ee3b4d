"""Reconciliation checks; each returns one row with its figures and a status."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.branches import run_together
from ledgerloom.functions.money import total
from ledgerloom.operators.mrr import with_next_opening
from ledgerloom.operators.payments import with_entity_keys
from ledgerloom.params import BRAND_CHARGE, LIVE_STATUSES, PAYOUT, PLATFORM_FEE, PROCESSOR_FEE, Band


def _status(ok: Column) -> Column:
    return F.when(ok, "pass").otherwise("fail").alias("status")


def _is_live(status: Column) -> Column:
    return F.lower(F.trim(status)).isin(*LIVE_STATUSES)


def _compared(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two one-row sums side by side, with their difference."""
    a, b = left.columns[0], right.columns[0]
    both = left.select(a, right.scalar().alias(b))
    delta = F.col(b) - F.col(a)
    return both.select(a, b, delta.alias("delta_cents"), _status(delta == 0))


def gmv_completeness(payments: DataFrame, brands: DataFrame, creators: DataFrame, daily: DataFrame) -> DataFrame:
    """Gross of all resolvable live raw payments against the mart's GMV."""
    live = payments.where(F.col("campaign_id").isNotNull() & _is_live(F.col("status")))
    known = with_entity_keys(live, brands, creators).where(
        F.col("brand_id").isNotNull() & F.col("creator_id").isNotNull()
    )
    return _compared(
        known.agg(total(F.col("amount_gross_cents")).alias("raw_payments_gmv_cents")),
        daily.agg(total(F.col("gmv_cents")).alias("mart_gmv_cents")),
    )


def ledger_balance(ledger: DataFrame, daily: DataFrame) -> DataFrame:
    """Margin entries of the ledger against the mart's gross margin."""
    margin = ledger.where(F.col("entry_type").isin(PLATFORM_FEE, PROCESSOR_FEE, PAYOUT))
    return _compared(
        margin.agg(total(F.col("amount_cents")).alias("ledger_margin_sum_cents")),
        daily.agg(total(F.col("gross_margin_cents")).alias("mart_gross_margin_sum_cents")),
    )


def mrr_invariant(waterfall: DataFrame) -> DataFrame:
    """No brand-month may close on another level than the next one opens on."""
    counted = with_next_opening(waterfall).agg(
        F.count_if(F.col("mrr_end_cents") != F.col("next_start_cents")).alias("violation_count"),
        F.count(F.lit(1)).alias("total_waterfall_rows"),
    )
    return counted.select("*", _status(F.col("violation_count") == 0))


def payout_discrepancy_rate(staged_payouts: DataFrame, band: Band) -> DataFrame:
    """Share of payouts that differ from the expected amount."""
    counted = staged_payouts.agg(
        F.count_if("has_payout_discrepancy").alias("mismatch_rows"), F.count(F.lit(1)).alias("total_rows")
    )
    # Without payouts the rate is 0.
    share = F.coalesce(
        F.col("mismatch_rows").cast("double") / F.nullif(F.col("total_rows"), F.lit(0)).cast("double"), F.lit(0.0)
    )
    return counted.select(
        "mismatch_rows",
        "total_rows",
        F.bround(share, 4).alias("rate"),
        F.lit(band.low).alias("expected_min"),
        F.lit(band.high).alias("expected_max"),
        _status(share.between(band.low, band.high)),
    )


def unmatched_exist(unmatched: DataFrame) -> DataFrame:
    """The quarantine must not be empty."""
    counted = unmatched.agg(F.count(F.lit(1)).alias("unmatched_row_count"))
    return counted.select("*", _status(F.col("unmatched_row_count") > 0))


def no_test_in_mart(payments: DataFrame, ledger: DataFrame, staged_payments: DataFrame) -> DataFrame:
    """No charge of a test payment may reach the ledger.

    Passes outright when no test payment was ever charged.
    """
    tests = payments.where(F.col("campaign_id").isNull() & _is_live(F.col("status")))
    charges = ledger.where(F.col("entry_type") == BRAND_CHARGE).select("payment_id", "amount_cents")
    staged_tests = staged_payments.where("is_test_transaction").select("payment_id")
    leaked = charges.join(staged_tests, "payment_id").agg(total(F.col("amount_cents")).alias("leaked"))
    sums = tests.agg(total(F.col("amount_gross_cents")).alias("test_transaction_raw_gmv_cents")).select(
        "test_transaction_raw_gmv_cents", leaked.scalar().alias("test_transaction_ledger_gmv_cents")
    )
    ok = (F.col("test_transaction_raw_gmv_cents") == 0) | (F.col("test_transaction_ledger_gmv_cents") == 0)
    return sums.select("*", _status(ok))


def take_rate_range(daily: DataFrame, band: Band) -> DataFrame:
    """All gross take rates in the band; fails when there is none."""
    seen = daily.agg(
        F.min("take_rate_gross").cast("double").alias("min_take_rate_gross"),
        F.max("take_rate_gross").cast("double").alias("max_take_rate_gross"),
        F.count("take_rate_gross").alias("non_null_rows"),
    )
    inside = (F.col("min_take_rate_gross") >= band.low) & (F.col("max_take_rate_gross") <= band.high)
    return seen.select(
        "*",
        F.lit(band.low).alias("expected_min"),
        F.lit(band.high).alias("expected_max"),
        _status(F.coalesce(inside, F.lit(False))),
    )


def descriptions(payout_discrepancy: Band, take_rate: Band) -> dict[str, str]:
    """Check names and what is shown with them, the limits as they are set."""
    low, high = (f"{100 * x:g}%" for x in (payout_discrepancy.low, payout_discrepancy.high))
    # Check names and texts.
    return {
        "V1": "GMV completeness: resolvable raw_payments sum == mart_daily_financials sum",
        "V2": "Ledger balance: margin entries sum == mart gross_margin_cents sum",
        "V3": "MRR invariant: mrr_end[t] == mrr_start[t+1] for all consecutive months",
        "V4": f"Payout discrepancy rate between {low} and {high}",
        "V5": "stg_unmatched_events is non-empty (quarantine pipeline ran)",
        "V6": "No test transactions in mart GMV",
        "V7": f"take_rate_gross in [{take_rate.low:.2f}, {take_rate.high:.2f}] for all rows",
    }


RESULT_SCHEMA = "name STRING, status STRING, detail MAP<STRING,STRING>"


def as_result(name: str, checked: DataFrame, description: str) -> DataFrame:
    """A check's row as name, status and a map of its figures; NULL figures are left out."""
    figures = [c for c in checked.columns if c != "status"]
    pairs = F.array(
        F.struct(F.lit("description").alias("key"), F.lit(description).alias("value")),
        *(F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")) for c in figures),
    )
    detail = F.map_from_entries(F.filter(pairs, lambda pair: pair["value"].isNotNull()))
    return checked.select(F.lit(name).alias("name"), "status", detail.alias("detail"))


def run_checks(
    spark: SparkSession, checks: Mapping[str, Callable[[], DataFrame]], texts: Mapping[str, str] | None = None
) -> DataFrame:
    """Run every check, whatever the others do, side by side; an exception is a failed check.

    Only the one row of each check reaches the driver.
    """

    def result(name: str, check: Callable[[], DataFrame]) -> tuple:
        try:
            return tuple(as_result(name, check(), (texts or {}).get(name, name)).first())
        except Exception as error:  # noqa: BLE001 - any failure is a result here
            return name, "fail", {"error": str(error)}

    found = run_together(spark, {name: partial(result, name, check) for name, check in checks.items()})
    return spark.createDataFrame([found[name] for name in checks], RESULT_SCHEMA)


def summarise(results: DataFrame, generated_at: dt.datetime) -> DataFrame:
    """One report: when, how many passed and failed, and every result in order of name."""
    passed = F.count_if(F.col("status") == "pass")
    total_checks = F.count(F.lit(1))
    return results.agg(
        F.struct(
            total_checks.alias("total"), passed.alias("passed"), (total_checks - passed).alias("failed")
        ).alias("summary"),
        F.array_sort(
            F.collect_list(F.struct("name", "status", "detail")),
            lambda a, b: F.when(a["name"] < b["name"], -1).when(a["name"] > b["name"], 1).otherwise(0),
        ).alias("assertions"),
    ).select(F.lit(generated_at).alias("generated_at"), "summary", "assertions")


_REPORT_SCHEMA = (
    "generated_at TIMESTAMP, summary STRUCT<total: BIGINT, passed: BIGINT, failed: BIGINT>, "
    "assertions ARRAY<STRUCT<name: STRING, status: STRING, detail: MAP<STRING,STRING>>>"
)


def write_report(results: DataFrame, folder: str, generated_at: dt.datetime) -> None:
    """Append one timestamped JSON report, passed or not."""
    summarise(results, generated_at).write.mode("append").json(folder)


def latest_report(spark: SparkSession, folder: str) -> DataFrame:
    """Results of the newest report in a folder of reports."""
    reports = spark.read.schema(_REPORT_SCHEMA).json(folder)
    newest = reports.orderBy(F.desc("generated_at")).limit(1)
    return newest.select("generated_at", "summary", F.inline("assertions"))
