"""Counts of broken invariants, and the step that stops a build on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.mrr import continuity_breaks
from ledgerloom.params import Band


class InvariantError(RuntimeError):
    """A table breaks a rule that everything after it relies on."""


class CheckError(InvariantError):
    """A reconciliation check of a build failed, or was not run."""


class ContinuityError(InvariantError):
    """A month does not open on the revenue the month before closed with."""


def mixed_case_statuses(staged_payments: DataFrame) -> DataFrame:
    return staged_payments.agg(F.count_if(F.col("status") != F.lower("status")).alias("violations"))


def missing_brands(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.agg(F.count_if(F.col("brand_id").isNull()).alias("violations"))


def missing_start_dates(subscriptions: DataFrame) -> DataFrame:
    """Spans whose creation has no time and so no start day and no id."""
    return subscriptions.agg(F.count_if(F.col("start_date").isNull()).alias("violations"))


def spans_outside(subscriptions: DataFrame, calendar: DataFrame) -> DataFrame:
    """Spans that start or end on a day the calendar does not reach: their months would be cut off."""
    days = calendar.agg(F.struct(F.min("date_day").alias("lo"), F.max("date_day").alias("hi")).alias("days"))
    seen = subscriptions.agg(
        F.min("start_date").alias("first_day"),
        F.greatest(F.max("start_date"), F.max("end_date")).alias("last_day"),
    ).select("*", days.scalar().alias("_days"))
    outside = (F.col("first_day") < F.col("_days.lo")) | (F.col("last_day") > F.col("_days.hi"))
    unknown = F.col("first_day").isNotNull() & F.col("_days.lo").isNull()
    return seen.select("first_day", "last_day", (F.coalesce(outside, F.lit(False)) | unknown).cast("int").alias("violations"))


def take_rate_extremes(daily: DataFrame, band: Band) -> DataFrame:
    """Smallest and largest gross take rate and whether both lie in the band.

    Without any rate there is nothing to object to.
    """
    seen = daily.agg(F.min("take_rate_gross").alias("low"), F.max("take_rate_gross").alias("high"))
    low, high = F.col("low").cast("double"), F.col("high").cast("double")
    return seen.select(
        low.alias("min_take_rate"),
        high.alias("max_take_rate"),
        F.coalesce((low < band.low) | (high > band.high), F.lit(False)).cast("int").alias("violations"),
    )


def broken_months(waterfall: DataFrame) -> DataFrame:
    return continuity_breaks(waterfall).agg(F.count(F.lit(1)).alias("violations"))


def require_none(count: int, message: str) -> None:
    """Raise if a figure gathered while a table was written counts violations."""
    if count:
        raise InvariantError(f"{message}: {count}")


def require(checked: DataFrame, message: str, error: type[InvariantError] = InvariantError) -> None:
    """Raise if the one row of a guard counts violations."""
    row = checked.first()
    if row["violations"]:
        raise error(f"{message}: {row.asDict()}")


def require_rows(count: int, message: str) -> None:
    """Raise if a table came out empty."""
    if not count:
        raise InvariantError(message)
