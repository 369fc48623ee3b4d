"""Monthly recurring revenue per brand: spine, levels, movements, continuity.

A subscription raises a brand's revenue in its first month and lowers it in the
month after its last, so a brand is described by its change months alone. Those
are summed in the map tasks and windowed (a brand has at most one row per
calendar month), and the full month series is spread out of them at the end,
where no shuffle follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.dates import month_after, month_of, month_sequence


def spine_bounds(subscriptions: DataFrame, calendar: DataFrame) -> DataFrame:
    """First and last month of the spine, one row; no row if there is no month.

    From the month of the earliest start to the month after the latest end (or
    the latest start while nothing has ended), as far as the calendar reaches.
    """
    days = calendar.agg(F.struct(F.min("date_day").alias("lo"), F.max("date_day").alias("hi")).alias("days"))
    span = subscriptions.agg(
        F.min("start_date").alias("_start"),
        month_after(F.coalesce(F.max("end_date"), F.max("start_date"))).alias("_stop"),
    ).select("_start", "_stop", days.scalar().alias("_days"))
    return span.select(
        month_of(F.greatest("_start", "_days.lo")).alias("first_month"),
        month_of(F.least("_stop", "_days.hi")).alias("last_month"),
    ).where(F.col("first_month") <= F.col("last_month"))


def _bound(bounds: DataFrame, name: str) -> Column:
    return bounds.select(name).scalar()


def brand_month_spine(subscriptions: DataFrame, calendar: DataFrame) -> DataFrame:
    """Every subscribed brand in every month of the spine."""
    bounds = spine_bounds(subscriptions, calendar)
    months = month_sequence(_bound(bounds, "first_month"), _bound(bounds, "last_month"))
    return (
        subscriptions.select("brand_id").distinct().select("brand_id", F.explode(months).alias("month_start_date"))
    )


def _change(month: Column, cents: Column) -> Column:
    return F.struct(month.alias("month"), cents.alias("delta"))


def _levels(subscriptions: DataFrame, bounds: DataFrame) -> DataFrame:
    """Change months of every brand: month, last month before the next change, level, level before."""
    spans = subscriptions.select(
        "brand_id",
        month_of(F.col("start_date")).alias("_start"),
        month_of(F.col("end_date")).alias("_end"),
        F.col("mrr_cents").alias("_mrr"),
        _bound(bounds, "first_month").alias("_first"),
    )
    first, start, end, mrr = F.col("_first"), F.col("_start"), F.col("_end"), F.col("_mrr")
    # Months, not days: a span that ends before it starts counts in that month.
    ever_active = start.isNotNull() & (end.isNull() | (end >= start))
    changes = F.array(
        # Every brand's series begins with the spine.
        _change(first, F.lit(0).cast("bigint")),
        F.when(ever_active, _change(F.greatest(start, first), mrr)),
        F.when(ever_active & end.isNotNull(), _change(F.greatest(month_after(end), first), -mrr)),
    )
    per_month = (
        spans.select("brand_id", F.inline(changes))
        .where(F.col("month").isNotNull())
        .groupBy("brand_id", "month")
        .agg(F.sum("delta").alias("delta"))
    )
    by_month = Window.partitionBy("brand_id").orderBy("month")
    last, level = F.col("_last"), F.col("level")
    levels = per_month.select(
        "brand_id",
        "month",
        "delta",
        F.sum("delta").over(by_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("level"),
        F.lead("month").over(by_month).alias("_next"),
        F.lag("month").over(by_month).alias("_previous"),
        _bound(bounds, "last_month").alias("_last"),
    )
    return levels.where(F.col("month") <= last).select(
        "brand_id",
        "month",
        F.least(F.coalesce(F.add_months("_next", -1), last), last).alias("until"),
        "level",
        F.when(F.col("_previous").isNotNull(), level - F.col("delta")).alias("prior"),
    )


def brand_month_mrr(subscriptions: DataFrame, calendar: DataFrame) -> DataFrame:
    """Revenue of every spine month: the subscriptions active on any day of it."""
    return _levels(subscriptions, spine_bounds(subscriptions, calendar)).select(
        "brand_id",
        F.explode(month_sequence(F.col("month"), F.col("until"))).alias("month_start_date"),
        F.col("level").alias("mrr_cents"),
    )


def mrr_waterfall(subscriptions: DataFrame, calendar: DataFrame) -> DataFrame:
    """Opening and closing revenue of every brand-month and the movement between.

    New revenue exists only in the first month of the spine, where there is no
    month before; a later rise from 0 shows in the closing level alone.
    """
    return waterfall_between(subscriptions, spine_bounds(subscriptions, calendar))


def waterfall_between(subscriptions: DataFrame, bounds: DataFrame) -> DataFrame:
    """The waterfall of some brands over the months of ``bounds`` (first_month, last_month; one row)."""
    levels = _levels(subscriptions, bounds)
    spread = levels.select(
        "*", F.posexplode(month_sequence(F.col("month"), F.col("until"))).alias("_age", "month_start_date")
    )
    # Only the first month of a level moves; the others open and close on it.
    level = F.col("level")
    moved = F.col("_age") == 0
    prior = F.when(moved, F.col("prior")).otherwise(level)
    opened = F.coalesce(prior, F.lit(0).cast("bigint"))
    nothing = F.lit(0).cast("bigint")
    return spread.select(
        "brand_id",
        "month_start_date",
        opened.alias("mrr_start_cents"),
        F.when(prior.isNull(), F.greatest(level, nothing)).otherwise(nothing).alias("mrr_new_cents"),
        F.when(opened > 0, F.greatest(level - opened, nothing)).otherwise(nothing).alias("mrr_expansion_cents"),
        F.when(level > 0, F.greatest(opened - level, nothing)).otherwise(nothing).alias("mrr_contraction_cents"),
        F.when(level == 0, F.greatest(opened, nothing)).otherwise(nothing).alias("mrr_churned_cents"),
        level.alias("mrr_end_cents"),
    )


def with_next_opening(waterfall: DataFrame) -> DataFrame:
    """Add the opening revenue of the brand's next month, NULL in its last."""
    by_month = Window.partitionBy("brand_id").orderBy("month_start_date")
    return waterfall.select("brand_id", "month_start_date", "mrr_start_cents", "mrr_end_cents").withColumn(
        "next_start_cents", F.lead("mrr_start_cents").over(by_month)
    )


def continuity_breaks(waterfall: DataFrame) -> DataFrame:
    """Brand-months whose closing revenue is not the next month's opening revenue."""
    return (
        with_next_opening(waterfall)
        .where(F.col("mrr_end_cents") != F.col("next_start_cents"))
        .select("brand_id", "month_start_date", "mrr_end_cents", "next_start_cents")
    )
