"""Date spine."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.dates import month_of


def _describe(days: DataFrame) -> DataFrame:
    day = F.col("date_day")
    weekday = F.dayofweek(day) - 1  # 0 = Sunday
    return days.select(
        "date_day",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.weekofyear(day).alias("week"),
        weekday.alias("day_of_week"),
        weekday.isin(0, 6).alias("is_weekend"),
        month_of(day).alias("month_start"),
        F.last_day(day).alias("month_end"),
    )


def _spread(one_row: DataFrame, first: Column, last: Column) -> DataFrame:
    return one_row.select(F.explode(F.sequence(first, last)).alias("date_day"))


def dim_date(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """One row per day from ``first`` to ``last``."""
    return _describe(_spread(spark.range(1), F.lit(first), F.lit(last)))


def dim_date_around(facts: DataFrame, at: str, months_before: int, months_after: int) -> DataFrame:
    """Whole months around the earliest and latest time of a fact table."""
    day = F.col(at).cast("date")
    bounds = facts.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    first = F.add_months(month_of(F.col("lo")), -months_before)
    last = F.last_day(F.add_months(F.col("hi"), months_after))
    return _describe(_spread(bounds.where(F.col("lo").isNotNull()), first, last))


def calendar_of(spans: DataFrame, months_before: int, months_after: int) -> DataFrame:
    """A calendar that holds every start and end of the spans."""
    days = spans.select(F.explode(F.array("start_date", "end_date")).alias("day"))
    return dim_date_around(days, "day", months_before, months_after)


def missing_days(days: DataFrame, existing: DataFrame) -> DataFrame:
    """Days not yet in the calendar, for a load that may be repeated."""
    return days.join(existing.select("date_day"), "date_day", "left_anti")
