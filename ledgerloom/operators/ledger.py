"""Fan-out of payments into signed ledger entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.params import BRAND_CHARGE, LIVE_STATUSES, PAYOUT, PLATFORM_FEE, PROCESSOR_FEE, REFUND


def _entry(entry_type: str, amount: Column) -> Column:
    return F.struct(F.lit(entry_type).alias("entry_type"), amount.alias("amount_cents"))


def live_payments(staged_payments: DataFrame) -> DataFrame:
    """Payments that count: not a test, and paid or refunded."""
    return staged_payments.where(~F.col("is_test_transaction") & F.lower("status").isin(*LIVE_STATUSES))


def ledger_entries(staged_payments: DataFrame, payouts: DataFrame) -> DataFrame:
    """Signed entries of every live payment and of its completed payouts.

    The entries that come from the payment itself are fanned out of one scan
    without a shuffle; only payouts need a join.
    """
    live = live_payments(staged_payments)
    refunded = F.col("amount_refunded_cents")
    own = F.array(
        _entry(BRAND_CHARGE, F.col("amount_gross_cents")),
        _entry(PLATFORM_FEE, F.col("platform_fee_cents")),
        _entry(PROCESSOR_FEE, -F.col("stripe_fee_cents")),
        _entry(REFUND, F.when(refunded > 0, -refunded)),
    )
    charged = (
        live.select("payment_id", F.col("paid_at").cast("date").alias("entry_date"), F.inline(own))
        .where((F.col("entry_type") != REFUND) | F.col("amount_cents").isNotNull())
        .select("payment_id", "entry_type", "amount_cents", "entry_date")
    )
    paid_out = (
        payouts.where(F.col("status") == "paid")
        .select("payment_id", "amount_paid_cents", "payout_at")
        .join(live.select("payment_id"), "payment_id")
        .select(
            "payment_id",
            F.lit(PAYOUT).alias("entry_type"),
            (-F.col("amount_paid_cents")).alias("amount_cents"),
            F.col("payout_at").cast("date").alias("entry_date"),
        )
    )
    return charged.unionByName(paid_out)
