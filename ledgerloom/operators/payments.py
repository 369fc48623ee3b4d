"""Staging of payments and payouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_entity_keys(payments: DataFrame, brands: DataFrame, creators: DataFrame) -> DataFrame:
    """Payments with the keys of their brand and creator, NULL where unknown.

    No broadcast hint: Spark broadcasts a dimension that is small by its own
    size check and otherwise shuffles, splitting hot keys at run time.
    """
    return payments.join(brands.select("brand_external_id", "brand_id"), "brand_external_id", "left").join(
        creators.select("creator_external_id", "creator_id"), "creator_external_id", "left"
    )


def _is_test() -> Column:
    return F.col("campaign_id").isNull()


def _resolves() -> Column:
    return F.col("brand_id").isNotNull() & F.col("creator_id").isNotNull()


def unresolved(keyed: DataFrame) -> DataFrame:
    """Payments :func:`stage_keyed_payments` leaves out."""
    return keyed.where(~_is_test() & ~_resolves())


def stage_keyed_payments(keyed: DataFrame) -> DataFrame:
    """Normalised payments out of :func:`with_entity_keys`; tests are kept and flagged."""
    return keyed.where(_is_test() | _resolves()).select(
        "payment_id",
        "campaign_id",
        "brand_id",
        "creator_id",
        "amount_gross_cents",
        "platform_fee_cents",
        "stripe_fee_cents",
        "amount_refunded_cents",
        F.lower(F.trim("status")).alias("status"),
        "paid_at",
        _is_test().alias("is_test_transaction"),
    )


def stage_payments(payments: DataFrame, brands: DataFrame, creators: DataFrame) -> DataFrame:
    """Normalised payments: test payments are kept and flagged, others must resolve."""
    return stage_keyed_payments(with_entity_keys(payments, brands, creators))


def stage_payouts(payouts: DataFrame, staged_payments: DataFrame, creators: DataFrame) -> DataFrame:
    """Payouts of staged payments with the gap between paid and expected."""
    gap = F.col("amount_paid_cents") - F.col("expected_payout_cents")
    payment = staged_payments.select("payment_id", "brand_id")
    creator = creators.select("creator_external_id", "creator_id")
    return (
        payouts.join(payment, "payment_id")
        .join(creator, "creator_external_id", "left")
        .select(
            "payout_id",
            "payment_id",
            "brand_id",
            "creator_id",
            "amount_paid_cents",
            "expected_payout_cents",
            (F.abs(gap) > 0).alias("has_payout_discrepancy"),
            gap.alias("discrepancy_cents"),
            "status",
            "payout_at",
        )
    )
