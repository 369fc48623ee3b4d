"""Hand-made input tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.operators.calendar import dim_date
from ledgerloom.sources import schemas

UTC = dt.timezone.utc


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text).replace(tzinfo=UTC)


def calendar(spark: SparkSession) -> DataFrame:
    return dim_date(spark, day("2022-07-01"), day("2024-07-31"))


def brands(spark: SparkSession, *ids: int) -> DataFrame:
    rows = [(i, f"BRD-{i:06d}", f"brand {i}", "retail", "SMB", at("2022-01-01")) for i in ids]
    return spark.createDataFrame(rows, schemas.DIM_BRAND)


def creators(spark: SparkSession, *ids: int) -> DataFrame:
    rows = [(i, f"CRT-{i:08d}", f"creator {i}", "nano", "food", at("2022-01-01")) for i in ids]
    return spark.createDataFrame(rows, schemas.DIM_CREATOR)


def events(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """(event_id, raw_event_id, brand, type, plan, period, cents, time text or None, coerced)."""
    fixed = [(*r[:7], at(r[7]) if r[7] else None, r[8]) for r in rows]
    return spark.createDataFrame(fixed, schemas.RAW_SUBSCRIPTION_EVENTS)


def subscriptions(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """(brand_id, start, end or None, monthly cents)."""
    fixed = [
        (f"sub-{i}", brand, "starter", "monthly", day(start), day(end) if end else None, cents)
        for i, (brand, start, end, cents) in enumerate(rows)
    ]
    return spark.createDataFrame(fixed, schemas.STG_SUBSCRIPTIONS)


def raw_payments(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """(id, campaign, brand, creator, gross, platform, processor, refund, status, time)."""
    return spark.createDataFrame([(*r[:9], at(r[9])) for r in rows], schemas.RAW_PAYMENTS)


def staged_payments(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """(id, gross, platform, processor, refund, status, time, is_test)."""
    fixed = [
        (i, None if test else 1, 1, 1, gross, platform, processor, refund, status, at(paid), test)
        for i, gross, platform, processor, refund, status, paid, test in rows
    ]
    return spark.createDataFrame(fixed, schemas.STG_PAYMENTS)


def raw_payouts(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """(id, payment, creator, expected, paid, status, time)."""
    return spark.createDataFrame([(*r[:6], at(r[6])) for r in rows], schemas.RAW_PAYOUTS)


def plain(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
