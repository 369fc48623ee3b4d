"""Daily financials from the ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.money import rate, total
from ledgerloom.params import BRAND_CHARGE, PAYOUT, PLATFORM_FEE, PROCESSOR_FEE, REFUND


def _sum_of(entry_type: str) -> Column:
    return total(F.when(F.col("entry_type") == entry_type, F.col("amount_cents")))


def daily_financials(ledger: DataFrame) -> DataFrame:
    """One row per day that has entries, with its totals and take rates.

    One hash aggregate over five conditional sums; every map task sends at most
    one row per day, so busy days do not matter.
    """
    sums = ledger.groupBy("entry_date").agg(
        _sum_of(BRAND_CHARGE).alias("gmv_cents"),
        _sum_of(REFUND).alias("_refunds"),
        _sum_of(PLATFORM_FEE).alias("platform_revenue_cents"),
        _sum_of(PROCESSOR_FEE).alias("_fees"),
        _sum_of(PAYOUT).alias("_payouts"),
    )
    gmv, revenue = F.col("gmv_cents"), F.col("platform_revenue_cents")
    net = gmv + F.col("_refunds")
    return sums.select(
        "entry_date",
        gmv,
        net.alias("net_gmv_cents"),
        revenue,
        (-F.col("_fees")).alias("stripe_fees_cents"),
        (-F.col("_payouts")).alias("creator_payouts_cents"),
        (revenue + F.col("_fees") + F.col("_payouts")).alias("gross_margin_cents"),
        rate(revenue, gmv, 6).cast("decimal(10,6)").alias("take_rate_gross"),
        rate(revenue, net, 6).cast("decimal(10,6)").alias("take_rate_net"),
    )
