"""From raw subscription events to subscription spans."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.keys import event_fingerprint, subscription_id, with_group_sequence
from ledgerloom.functions.dates import iso_text
from ledgerloom.params import EVENT_CANCELLED, EVENT_CREATED, PERIOD_ANNUAL

# Event ids in one stored array at most.
PART_EVENTS = 10_000


def raw_event_ids(events: DataFrame) -> DataFrame:
    """Number every brand's events in id order and derive their deterministic ids."""
    owned = events.withColumn("owner", F.coalesce("brand_external_id", F.lit("")))
    numbered = with_group_sequence(owned, "owner", "event_id", "event_seq")
    return numbered.select(
        "event_id",
        "owner",
        "event_seq",
        event_fingerprint(F.col("owner"), F.col("event_type"), iso_text(F.col("event_at")), F.col("event_seq")).alias(
            "derived_event_id"
        ),
    )


def event_id_collisions(ids: DataFrame, id_col: str) -> DataFrame:
    """How often an id is shared by several events, over the whole table."""
    per_id = ids.groupBy(id_col).agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_events"),
        F.count(F.lit(1)).alias("distinct_ids"),
        F.count_if(F.col("n") > 1).alias("colliding_ids"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).alias("surplus_events"),
    )


def dedup_events(events: DataFrame) -> DataFrame:
    """The latest event of every raw id, among events that name a brand.

    Copies with the same time are settled by the lowest event id. Spark keeps
    one row per id in every task before the shuffle, so an id with very many
    copies does not pile up behind it.
    """
    newest_first = Window.partitionBy("raw_event_id").orderBy(F.desc_nulls_last("event_at"), F.asc("event_id"))
    return (
        events.where(F.col("brand_external_id").isNotNull())
        .withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def coerce_event_time(events: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Add ``event_at_utc``: coerced events without a time get ``as_of``."""
    at = F.col("event_at")
    stand_in = F.lit(as_of).cast(events.schema["event_at"].dataType)
    return events.withColumn("event_at_utc", F.when(F.col("_tz_coerced"), F.coalesce(at, stand_in)).otherwise(at))


def resolve_brands(events: DataFrame, brands: DataFrame) -> DataFrame:
    """Events of known brands with the brand's key."""
    return events.join(brands.select("brand_external_id", "brand_id"), "brand_external_id")


def resolved_events(events: DataFrame, brands: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Deduplicated events of known brands with their UTC day."""
    timed = coerce_event_time(dedup_events(events), as_of)
    return resolve_brands(timed, brands).withColumn("event_date", F.col("event_at_utc").cast("date"))


_SPAN = ("brand_id", "plan_name", "billing_period", "amount_cents", "start_date")


def _creations(resolved: DataFrame) -> DataFrame:
    return resolved.where(F.col("event_type") == EVENT_CREATED).withColumnRenamed("event_date", "start_date")


def created_spans(resolved: DataFrame) -> DataFrame:
    """One row per started span with the number and range of its source events."""
    return (
        _creations(resolved)
        .groupBy(*_SPAN)
        .agg(
            F.count(F.lit(1)).alias("source_event_count"),
            F.min("event_id").alias("first_source_event_id"),
            F.max("event_id").alias("last_source_event_id"),
        )
    )


def span_source_events(resolved: DataFrame) -> DataFrame:
    """The source events of every started span, one row per event.

    The long form of the id list: it has no group to collect, whatever the
    number of events behind a span.
    """
    return _creations(resolved).select(*_SPAN, F.col("event_id").alias("source_event_id"))


def cancel_dates(resolved: DataFrame) -> DataFrame:
    """Earliest cancellation day of every brand and plan."""
    cancelled = resolved.where(F.col("event_type") == EVENT_CANCELLED)
    return cancelled.groupBy("brand_id", "plan_name").agg(F.min("event_date").alias("end_date"))


def stage_subscriptions(resolved: DataFrame) -> DataFrame:
    """Subscription spans with their end and their monthly recurring revenue.

    A span is a (brand, plan, start day); of several offers on that day the
    first by period and amount counts, and the earliest cancellation of the
    brand's plan ends it. Both facts come from one pass: events shrink to one
    row per day and period inside the map tasks, so a brand-plan has no more
    rows than the calendar has days when its windows run.
    """
    created = F.col("event_type") == EVENT_CREATED
    cancelled = F.col("event_type") == EVENT_CANCELLED
    daily = (
        resolved.where(created | cancelled)
        .groupBy("brand_id", "plan_name", F.col("event_date").alias("start_date"), "billing_period")
        .agg(
            F.min(F.when(created, F.col("amount_cents"))).alias("amount_cents"),
            F.max(F.when(cancelled, F.col("event_date"))).alias("_cancelled_on"),
        )
    )
    started = F.col("amount_cents").isNotNull()
    offers = Window.partitionBy("brand_id", "plan_name", "start_date").orderBy(F.desc("_started"), "billing_period")
    plan = Window.partitionBy("brand_id", "plan_name")
    spans = (
        daily.withColumn("end_date", F.min("_cancelled_on").over(plan))
        .withColumn("_started", started)
        .withColumn("_offer", F.row_number().over(offers))
        .where(started & (F.col("_offer") == 1))
    )
    annual = F.col("billing_period") == PERIOD_ANNUAL
    return spans.select(
        subscription_id(F.col("brand_id"), F.col("plan_name"), F.col("start_date")).alias("subscription_id"),
        "brand_id",
        "plan_name",
        "billing_period",
        "start_date",
        "end_date",
        F.when(annual, F.expr("amount_cents div 12"))
        .otherwise(F.col("amount_cents"))
        .cast("bigint")
        .alias("mrr_cents"),
    )


def subscription_sources(resolved: DataFrame) -> DataFrame:
    """(subscription_id, event_id) of the events that started each staged span.

    Only events of the counting offer are sources: the first period of the day
    and its lowest amount.
    """
    events = span_source_events(resolved)
    span = ("brand_id", "plan_name", "start_date")
    by_period = events.groupBy(*span, "billing_period").agg(F.min("amount_cents").alias("amount_cents"))
    offers = Window.partitionBy(*span).orderBy("billing_period")
    counting = (
        by_period.withColumn("_offer", F.row_number().over(offers)).where(F.col("_offer") == 1).drop("_offer")
    )
    return events.join(counting, list(_SPAN)).select(
        subscription_id(F.col("brand_id"), F.col("plan_name"), F.col("start_date")).alias("subscription_id"),
        F.col("source_event_id").alias("event_id"),
    )


def source_array_parts(sources: DataFrame, part_size: int = PART_EVENTS) -> DataFrame:
    """The source events of every subscription as sorted arrays: (subscription_id, part_no, event_ids).

    An array is one value in one row, and a span may gather any number of
    events. So the ids of a span are numbered in order and cut into parts of at
    most ``part_size``: every span has all its ids, and no value is larger than
    a part. ``sources`` is the long form, with unique event ids.

    A span of up to PART_EVENTS events is gathered at once, by one shuffle, and
    its array cut; only the events of longer ones are numbered range by range.
    """
    known = sources.where(F.col("subscription_id").isNotNull() & F.col("event_id").isNotNull())
    # Spans that share a hash are counted together, so no long one is missed; a mark stands for over PART_EVENTS rows.
    marked = known.withColumn("_mark", F.xxhash64("subscription_id"))
    counts = marked.groupBy("_mark").agg(F.count(F.lit(1)).alias("_events"))
    long_marks = F.broadcast(counts.where(F.col("_events") > PART_EVENTS).select("_mark"))
    gathered = (
        marked.join(long_marks, "_mark", "left_anti")
        .groupBy("subscription_id")
        .agg(F.sort_array(F.collect_list("event_id")).alias("_ids"))
    )
    parts = F.sequence(F.lit(0).cast("long"), F.expr(f"(size(_ids) - 1) div {part_size}"))
    short = gathered.withColumn("part_no", F.explode(parts)).select(
        "subscription_id", "part_no", F.expr(f"slice(_ids, int(part_no * {part_size}) + 1, {part_size})").alias("event_ids")
    )
    long = marked.join(long_marks, "_mark", "left_semi").drop("_mark")
    numbered = with_group_sequence(long, "subscription_id", "event_id", "_seq")
    part = F.expr(f"(_seq - 1) div {part_size}").alias("part_no")
    return short.unionByName(
        numbered.groupBy("subscription_id", part).agg(F.sort_array(F.collect_list("event_id")).alias("event_ids"))
    )


def with_source_counts(subscriptions: DataFrame, sources: DataFrame) -> DataFrame:
    """Add the number of source events of every subscription."""
    counts = sources.groupBy("subscription_id").agg(F.count(F.lit(1)).alias("source_event_count"))
    return subscriptions.join(counts, "subscription_id", "left")
