"""Reporting datasets over the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.dates import month_number, month_of
from ledgerloom.functions.money import quotient, rate, thousands
from ledgerloom.params import MAX_COHORT_AGE

_DAILY_SUMS = (
    "gmv_cents",
    "net_gmv_cents",
    "platform_revenue_cents",
    "stripe_fees_cents",
    "creator_payouts_cents",
    "gross_margin_cents",
)


def monthly_financials(daily: DataFrame) -> DataFrame:
    """Monthly totals, take rate, and the headline amounts in thousands."""
    months = daily.groupBy(month_of(F.col("entry_date")).alias("month")).agg(
        *(F.sum(name).alias(name) for name in _DAILY_SUMS)
    )
    return months.select(
        "*",
        rate(F.col("platform_revenue_cents"), F.col("gmv_cents"), 4).cast("double").alias("take_rate_gross"),
        thousands(F.col("gmv_cents")).alias("gmv_k"),
        thousands(F.col("platform_revenue_cents")).alias("platform_revenue_k"),
        thousands(F.col("gross_margin_cents")).alias("gross_margin_k"),
    )


def monthly_mrr_waterfall(waterfall: DataFrame) -> DataFrame:
    """Monthly movements over all brands; what lowers revenue is negative."""
    months = waterfall.groupBy(F.col("month_start_date").alias("month")).agg(
        F.sum("mrr_new_cents").alias("new_cents"),
        F.sum("mrr_expansion_cents").alias("expansion_cents"),
        (-F.sum("mrr_contraction_cents")).alias("contraction_cents"),
        (-F.sum("mrr_churned_cents")).alias("churned_cents"),
        F.sum("mrr_end_cents").alias("mrr_end_cents"),
    )
    scaled = [thousands(F.col(c)).alias(c.replace("_cents", "_k")) for c in months.columns if c.endswith("_cents")]
    return months.select("*", *scaled)


def net_revenue_retention(waterfall: DataFrame) -> DataFrame:
    """Revenue kept from the month before in percent, NULL if there was none."""
    months = waterfall.groupBy(F.col("month_start_date").alias("month")).agg(
        F.count_if(F.col("mrr_end_cents") > 0).alias("active_brands"),
        F.sum("mrr_start_cents").alias("opening"),
        (
            F.sum("mrr_start_cents")
            + F.sum("mrr_expansion_cents")
            - F.sum("mrr_contraction_cents")
            - F.sum("mrr_churned_cents")
        ).alias("kept"),
    )
    percent = F.round(quotient(F.col("kept"), F.col("opening")) * 100, 2)
    return months.select("month", "active_brands", percent.cast("double").alias("nrr_pct"))


def cohort_retention(waterfall: DataFrame, max_age: int = MAX_COHORT_AGE) -> DataFrame:
    """Share of each cohort's brands with revenue, by months since its first.

    A cohort is the first month with revenue. Months before it have negative
    ages and 0 %; a brand without revenue belongs to no cohort. The cohort is
    found in a window over the brand, whose rows are bounded by the calendar.
    """
    active = F.col("mrr_end_cents") > 0
    brand = Window.partitionBy("brand_id")
    placed = (
        waterfall.select("brand_id", "month_start_date", "mrr_end_cents")
        .withColumn("cohort_month", F.min(F.when(active, F.col("month_start_date"))).over(brand))
        .where(F.col("cohort_month").isNotNull())
    )
    age = month_number(F.col("month_start_date")) - month_number(F.col("cohort_month"))
    # A brand has one row per month, so rows count brands.
    sizes = (
        placed.withColumn("month_index", age)
        .where(F.col("month_index") <= max_age)
        .groupBy("cohort_month", "month_index")
        .agg(F.count_if(active).alias("retained"), F.count(F.lit(1)).alias("cohort_size"))
    )
    percent = F.round(quotient(F.col("retained"), F.col("cohort_size")) * 100, 1)
    return sizes.select(
        "cohort_month", "month_index", "retained", "cohort_size", percent.cast("double").alias("retention_pct")
    )


def cohort_matrix(retention: DataFrame, max_age: int = MAX_COHORT_AGE) -> DataFrame:
    """Retention with one row per cohort and one column per age from 0 to ``max_age``."""
    ages = list(range(max_age + 1))
    wide = (
        retention.withColumn("cohort", F.date_format("cohort_month", "yyyy-MM"))
        .groupBy("cohort")
        .pivot("month_index", ages)
        .agg(F.first("retention_pct"))
    )
    return wide.select("cohort", *(F.col(str(age)).alias(f"M+{age}") for age in ages))


def quarantine_breakdown(unmatched: DataFrame) -> DataFrame:
    """Quarantined rows by reason, most frequent first."""
    return unmatched.groupBy("reason").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "reason")


def _change_pct(now: str, before: str) -> Column:
    """Change against the month before in percent, one decimal."""
    base = F.greatest(F.col(before), F.lit(1)).cast("double")
    return F.round((F.col(now) - F.col(before)).cast("double") / base * 100, 1)


def _latest(months: DataFrame, *measures: str) -> DataFrame:
    """The latest month with each measure's value the month before.

    ``months`` has one row per calendar month, so the unpartitioned window is
    small; a single month is compared with itself.
    """
    by_month = Window.orderBy("month")
    before = {f"_{m}": F.coalesce(F.lag(m).over(by_month), F.col(m)) for m in measures}
    return months.withColumns(before).orderBy(F.desc("month")).limit(1)


def gmv_kpis(financials: DataFrame) -> DataFrame:
    """Headline figures of the latest month of ``monthly_financials``."""
    return _latest(financials, "gmv_cents", "platform_revenue_cents").select(
        "month",
        "gmv_k",
        _change_pct("gmv_cents", "_gmv_cents").alias("gmv_mom_pct"),
        "platform_revenue_k",
        _change_pct("platform_revenue_cents", "_platform_revenue_cents").alias("platform_revenue_mom_pct"),
        "gross_margin_k",
    )


def mrr_kpis(movements: DataFrame) -> DataFrame:
    """Headline figures of the latest month of ``monthly_mrr_waterfall``."""
    net_new = F.col("new_cents") + F.col("expansion_cents") + F.col("contraction_cents") + F.col("churned_cents")
    return _latest(movements, "mrr_end_cents").select(
        "month",
        "mrr_end_k",
        _change_pct("mrr_end_cents", "_mrr_end_cents").alias("mrr_mom_pct"),
        thousands(net_new).alias("net_new_mrr_k"),
    )
