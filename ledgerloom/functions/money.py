"""Integer-cent arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: Column) -> Column:
    """An amount held as a double with two decimals, as integer cents.

    The product is off by far less than half a cent, so rounding is exact.
    """
    return F.rint(amount * 100).cast("bigint")


def share(cents_col: Column, rate: float) -> Column:
    """``rate`` of an amount, rounded half to even as a double."""
    return F.rint(cents_col.cast("double") * F.lit(rate)).cast("bigint")


def total(amount: Column) -> Column:
    """Sum that is 0 over no rows."""
    return F.coalesce(F.sum(amount), F.lit(0).cast("bigint"))


def quotient(numerator: Column, denominator: Column) -> Column:
    """Exact decimal quotient, NULL where the denominator is 0."""
    whole = "decimal(20,0)"
    return numerator.cast(whole) / F.nullif(denominator.cast(whole), F.lit(0).cast(whole))


def rate(numerator: Column, denominator: Column, digits: int) -> Column:
    """Quotient rounded half up to ``digits`` decimals."""
    return F.round(quotient(numerator, denominator), digits)


def thousands(cents_col: Column) -> Column:
    """Cents as thousands of currency units."""
    return cents_col.cast("double") / F.lit(100000.0)
