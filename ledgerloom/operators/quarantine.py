"""Rows that name entities the dimensions do not hold."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import spaced_text
from ledgerloom.operators.payments import unresolved, with_entity_keys
from ledgerloom.params import REASON_MISSING_BRAND, REASON_UNRESOLVED

# The fields of a quarantined row's payload, in their order.
_EVENT_PAYLOAD = (
    "event_id",
    "raw_event_id",
    "brand_external_id",
    "event_type",
    "plan_name",
    "billing_period",
    "amount_cents",
    "event_at",
    "_tz_coerced",
)
_PAYMENT_PAYLOAD = (
    "payment_id",
    "campaign_id",
    "brand_external_id",
    "creator_external_id",
    "amount_gross_cents",
    "status",
    "paid_at",
)


def _payload(df: DataFrame, names: tuple[str, ...]) -> Column:
    """The row as JSON: NULLs kept, times as text."""
    values = [
        spaced_text(F.col(n)).alias(n) if df.schema[n].dataType.typeName().startswith("timestamp") else F.col(n)
        for n in names
    ]
    return F.to_json(F.struct(*values), {"ignoreNullFields": "false"})


def _quarantined(df: DataFrame, table: str, id_col: str, reason: Column, payload: tuple[str, ...]) -> DataFrame:
    return df.select(
        F.lit(table).alias("source_table"),
        F.col(id_col).alias("source_row_id"),
        reason.alias("reason"),
        _payload(df, payload).alias("raw_payload"),
    )


def quarantine_missing_brand(events: DataFrame) -> DataFrame:
    """Events without a brand id."""
    missing = events.where(F.col("brand_external_id").isNull())
    return _quarantined(missing, "raw_subscription_events", "event_id", F.lit(REASON_MISSING_BRAND), _EVENT_PAYLOAD)


def quarantine_ghost_brand(events: DataFrame, brands: DataFrame) -> DataFrame:
    """Events with a brand id no brand has; copies of a bad event each count."""
    named = events.where(F.col("brand_external_id").isNotNull())
    ghosts = named.join(brands.select("brand_external_id"), "brand_external_id", "left_anti")
    return _quarantined(ghosts, "raw_subscription_events", "event_id", F.lit(REASON_UNRESOLVED), _EVENT_PAYLOAD)


def quarantine_keyed_payments(keyed: DataFrame) -> DataFrame:
    """Like :func:`quarantine_payments`, for payments that went through ``with_entity_keys`` already."""
    return _quarantined(unresolved(keyed), "raw_payments", "payment_id", F.lit(REASON_UNRESOLVED), _PAYMENT_PAYLOAD)


def quarantine_payments(payments: DataFrame, brands: DataFrame, creators: DataFrame) -> DataFrame:
    """Non-test payments whose brand or creator is missing or unknown."""
    return quarantine_keyed_payments(with_entity_keys(payments, brands, creators))


def unmatched_events(events: DataFrame, brands: DataFrame) -> DataFrame:
    """Events without a known brand. Those without an id need no join and are kept out of its shuffle."""
    return quarantine_missing_brand(events).unionByName(quarantine_ghost_brand(events, brands))


def unmatched_rows(events: DataFrame, keyed_payments: DataFrame, brands: DataFrame) -> DataFrame:
    """All quarantined rows; payments come with the keys they resolved to."""
    return unmatched_events(events, brands).unionByName(quarantine_keyed_payments(keyed_payments))


def with_quarantine_time(unmatched: DataFrame, as_of: dt.datetime) -> DataFrame:
    return unmatched.withColumn("quarantined_at", F.lit(as_of))


def stage_row_counts(staged: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of every staging table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in staged.items()
    ]
    return reduce(DataFrame.unionByName, counts)
