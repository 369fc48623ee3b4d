"""Month arithmetic and timestamp text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_of(day: Column) -> Column:
    """First day of the month as a DATE."""
    return F.trunc(day, "MM")


def month_after(day: Column) -> Column:
    """First day of the following month."""
    return F.add_months(month_of(day), 1)


def month_number(day: Column) -> Column:
    """Months since year 0, so that differences count whole months."""
    return F.year(day) * 12 + F.month(day)


def month_sequence(first: Column, last: Column) -> Column:
    """Every month start from ``first`` to ``last``; the caller keeps first <= last."""
    return F.sequence(first, last, F.expr("interval 1 month"))


def _utc_text(at: Column, pattern: str) -> Column:
    micros = F.date_format(at, "SSSSSS")
    fraction = F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros))
    return F.concat(F.date_format(at, pattern), fraction, F.lit("+00:00"))


def iso_text(at: Column) -> Column:
    """UTC timestamp as 2023-06-15T08:00:00+00:00."""
    return _utc_text(at, "yyyy-MM-dd'T'HH:mm:ss")


def spaced_text(at: Column) -> Column:
    """UTC timestamp as 2023-06-15 08:00:00+00:00."""
    return _utc_text(at, "yyyy-MM-dd HH:mm:ss")
