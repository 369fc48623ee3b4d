"""Load-time counts and the resolution of references to keys."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.payments import with_entity_keys


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def load_row_counts(expected: Mapping[str, DataFrame], loaded: Mapping[str, DataFrame]) -> DataFrame:
    """Rows each source holds against the rows its table received."""
    rows = [
        row_count(expected[table], "expected_rows").select(
            F.lit(table).alias("table_name"),
            "expected_rows",
            row_count(loaded[table], "n").scalar().alias("loaded_rows"),
        )
        for table in expected
    ]
    counted = reduce(DataFrame.unionByName, rows)
    return counted.withColumn("is_complete", F.col("expected_rows") == F.col("loaded_rows"))


def resolve_campaign_keys(campaigns: DataFrame, brands: DataFrame, creators: DataFrame) -> DataFrame:
    """Campaigns whose brand and creator both exist, with the integer keys of the two.

    No broadcast hint: the dimensions grow with the business, so whether they
    fit is left to Spark's size check, and hot brands to its skew-join split.
    """
    return (
        campaigns.join(brands.select("brand_external_id", "brand_id"), "brand_external_id")
        .join(creators.select("creator_external_id", "creator_id"), "creator_external_id")
        .drop("brand_external_id", "creator_external_id")
    )


def campaign_load_summary(campaigns: DataFrame, brands: DataFrame, creators: DataFrame) -> DataFrame:
    """How many campaigns were loaded and how many skipped."""
    placed = with_entity_keys(campaigns, brands, creators)
    both = F.col("brand_id").isNotNull() & F.col("creator_id").isNotNull()
    return placed.agg(
        F.count(F.lit(1)).alias("total_campaigns"),
        F.count_if(both).alias("loaded_campaigns"),
        F.count_if(~both).alias("skipped_campaigns"),
    )


def attach_campaign_keys(payments: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Payments with the key of the campaign they name.

    A payment that names none, or one that was not loaded, keeps a NULL
    campaign and so counts as a test payment.
    """
    return payments.join(campaigns.select("campaign_ref", "campaign_id"), "campaign_ref", "left").drop("campaign_ref")


def attach_payment_keys(payouts: DataFrame, payments: DataFrame) -> DataFrame:
    """Payouts with the key of their payment; payouts of unknown payments are not loaded."""
    return payouts.join(payments.select("payment_ref", "payment_id"), "payment_ref").drop("payment_ref")
