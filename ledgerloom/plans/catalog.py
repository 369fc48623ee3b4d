"""One query per operator, over the tables of a folder."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.keys import with_dense_key, with_row_key
from ledgerloom.operators import audits, calendar, checks, guards, loading, mrr, payments, quarantine, reports
from ledgerloom.operators import subscriptions as subs
from ledgerloom.plans import build as full_build
from ledgerloom.plans import refresh
from ledgerloom.plans.frames import Frames, StoredFrames
from ledgerloom.session import scratch_path
from ledgerloom.sources import colocated
from ledgerloom.sources.files import load_raw, write_raw
from ledgerloom.sources.keyed import KeyedTable
from ledgerloom.sources.schemas import RAW_PAYMENTS
from ledgerloom.sources.tables import RunFolder
from ledgerloom.streaming import intake
from ledgerloom.streaming import staging as streaming

Query = Callable[[SparkSession, str], DataFrame]

# What the queries over repeated loads hold back at first.
EARLY_DAY = dt.date(1996, 3, 15)
LATE_PAYMENT = "payment_id % 997 = 5"
# The payments whose status is written with line breaks.
NOTED_PAYMENT = "payment_id % 7 = 3"

# The tables whose keys are audited in bitmaps.
NUMBERED_TABLES = ("raw_payments", "raw_payouts")

_QUERIES: dict[str, Callable[[Frames], DataFrame]] = {}


def _query(build: Callable[[Frames], DataFrame]) -> Callable[[Frames], DataFrame]:
    _QUERIES[build.__name__] = build
    return build


def _flat(df: DataFrame) -> DataFrame:
    """Decimals as doubles and times as text, as query results show them."""
    shown = []
    for field in df.schema:
        kind, column = field.dataType.typeName(), F.col(f"`{field.name}`")
        if kind == "decimal":
            column = column.cast("double").alias(field.name)
        elif kind.startswith("timestamp"):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        shown.append(column)
    return df.select(*shown)


# Loading and keys


@_query
def load_raw_payments(f: Frames) -> DataFrame:
    path = scratch_path(f.spark, "raw_payments")
    write_raw(f.raw.raw_payments, path)
    return load_raw(f.spark, path, RAW_PAYMENTS)


@_query
def load_raw_multiline(f: Frames) -> DataFrame:
    """Payments whose status holds line breaks and quotes, written as CSV and read back by several tasks."""
    path = scratch_path(f.spark, "raw_notes")
    note = F.concat("status", F.lit('\n"see", no. '), F.col("payment_id").cast("string"), F.lit("\n"))
    noted = F.when(F.expr(NOTED_PAYMENT), note).otherwise(F.col("status"))
    write_raw(f.raw.raw_payments.withColumn("status", noted), path, multi_line=True)
    return load_raw(f.spark, path, RAW_PAYMENTS, multi_line=True)


@_query
def load_row_counts(f: Frames) -> DataFrame:
    raw = f.raw
    orders = raw.orders
    copied = orders.where("o_orderkey % 50 = 7")
    return loading.load_row_counts(
        {
            "dim_brand": raw.customers,
            "dim_creator": raw.suppliers,
            "raw_campaigns": orders,
            "raw_payments": orders,
            "raw_payouts": raw.payout_requests,
            "raw_subscription_events": orders.unionByName(copied),
        },
        {
            "dim_brand": raw.dim_brand,
            "dim_creator": raw.dim_creator,
            "raw_campaigns": f.campaigns,
            "raw_payments": raw.raw_payments,
            "raw_payouts": loading.attach_payment_keys(raw.payout_requests, raw.payment_requests),
            "raw_subscription_events": raw.raw_subscription_events,
        },
    )


@_query
def assign_surrogate_keys(f: Frames) -> DataFrame:
    brands = f.raw.dim_brand.select(F.lit("brand").alias("entity"), F.col("brand_external_id").alias("external_id"))
    creators = f.raw.dim_creator.select(
        F.lit("creator").alias("entity"), F.col("creator_external_id").alias("external_id")
    )
    return with_dense_key(brands, "external_id", "surrogate_key").unionByName(
        with_dense_key(creators, "external_id", "surrogate_key")
    )


@_query
def resolve_campaign_fks(f: Frames) -> DataFrame:
    return f.campaigns.drop("campaign_ref")


@_query
def campaign_load_summary(f: Frames) -> DataFrame:
    return loading.campaign_load_summary(f.raw.campaign_requests, f.raw.dim_brand, f.raw.dim_creator)


@_query
def resolve_payment_fks(f: Frames) -> DataFrame:
    return loading.attach_campaign_keys(f.raw.payment_requests, f.campaigns).drop("payment_ref")


@_query
def resolve_payout_fks(f: Frames) -> DataFrame:
    return loading.attach_payment_keys(f.raw.payout_requests, f.raw.payment_requests)


@_query
def dim_date(f: Frames) -> DataFrame:
    # Half a year before the first order to 16 months after the last.
    return calendar.dim_date_around(f.raw.orders, "o_orderdate", 6, 16)


@_query
def raw_event_ids(f: Frames) -> DataFrame:
    return subs.raw_event_ids(f.raw.raw_subscription_events)


@_query
def raw_event_id_collisions(f: Frames) -> DataFrame:
    events = f.raw.raw_subscription_events
    loaded = subs.event_id_collisions(events, "raw_event_id")
    derived = subs.event_id_collisions(subs.raw_event_ids(events), "derived_event_id")
    return loaded.select(F.lit("loaded").alias("id_source"), "*").unionByName(
        derived.select(F.lit("derived").alias("id_source"), "*")
    )


# Staging


@_query
def dedup_events(f: Frames) -> DataFrame:
    return subs.dedup_events(f.raw.raw_subscription_events)


@_query
def coerce_event_time(f: Frames) -> DataFrame:
    # Some coerced events lose their time altogether, as a stripped zone can do.
    at = F.when(F.expr("event_id div 2 % 100 <> 31"), F.col("event_at"))
    lost = f.raw.raw_subscription_events.withColumn("event_at", at)
    timed = subs.coerce_event_time(lost, f.params.as_of)
    return timed.select("event_id", "_tz_coerced", "event_at", "event_at_utc")


@_query
def resolve_brands(f: Frames) -> DataFrame:
    return f.resolved.select("event_id", "brand_id", "event_type", "plan_name", "event_date")


@_query
def created_spans(f: Frames) -> DataFrame:
    return subs.created_spans(f.resolved)


@_query
def created_span_events(f: Frames) -> DataFrame:
    return subs.span_source_events(f.resolved)


@_query
def cancel_dates(f: Frames) -> DataFrame:
    return subs.cancel_dates(f.resolved)


@_query
def stg_subscriptions(f: Frames) -> DataFrame:
    return f.subscriptions


@_query
def subscription_sources(f: Frames) -> DataFrame:
    return subs.subscription_sources(f.resolved)


@_query
def subscription_source_arrays(f: Frames) -> DataFrame:
    return f.source_arrays.select("subscription_id", "part_no", F.array_join("event_ids", ",").alias("event_ids"))


@_query
def stg_payments(f: Frames) -> DataFrame:
    return f.payments


@_query
def stg_payouts(f: Frames) -> DataFrame:
    return f.payouts


@_query
def colocated_payouts(f: Frames) -> DataFrame:
    """Staged payouts out of payments and payouts that were stored in buckets of the payment."""
    folder, mark = scratch_path(f.spark, "buckets"), uuid.uuid4().hex
    names = f"payouts_{mark}", f"payments_{mark}"
    # As many buckets as shuffle partitions: a later shuffle of one side alone would fit the other, too.
    buckets = int(f.spark.conf.get("spark.sql.shuffle.partitions"))
    sides = f.raw.raw_payouts, f.payments.select("payment_id", "brand_id")
    stored = colocated.store(f.spark, dict(zip(names, sides)), folder, "payment_id", buckets)
    return colocated.together(
        *(stored[n] for n in names), lambda payouts, paid: payments.stage_payouts(payouts, paid, f.raw.dim_creator)
    )


@_query
def quarantine_missing_brand(f: Frames) -> DataFrame:
    return quarantine.quarantine_missing_brand(f.raw.raw_subscription_events)


@_query
def quarantine_ghost_brand(f: Frames) -> DataFrame:
    return quarantine.quarantine_ghost_brand(f.raw.raw_subscription_events, f.raw.dim_brand)


@_query
def quarantine_payments(f: Frames) -> DataFrame:
    return quarantine.quarantine_payments(f.raw.raw_payments, f.raw.dim_brand, f.raw.dim_creator)


@_query
def stg_unmatched_events(f: Frames) -> DataFrame:
    return f.unmatched


@_query
def assert_lowercase_status(f: Frames) -> DataFrame:
    return guards.mixed_case_statuses(f.payments)


@_query
def assert_no_null_brand(f: Frames) -> DataFrame:
    return guards.missing_brands(f.subscriptions)


@_query
def stage_row_counts(f: Frames) -> DataFrame:
    return quarantine.stage_row_counts(
        {
            "stg_subscriptions": f.subscriptions,
            "stg_payments": f.payments,
            "stg_payouts": f.payouts,
            "stg_ledger_entries": f.ledger,
            "stg_unmatched_events": f.unmatched,
        }
    )


# Ledger and marts


@_query
def ledger_entries(f: Frames) -> DataFrame:
    return f.ledger


@_query
def ledger_entry_ids(f: Frames) -> DataFrame:
    return with_row_key(f.ledger, "ledger_id")


@_query
def unmatched_row_ids(f: Frames) -> DataFrame:
    return with_row_key(f.unmatched, "unmatched_id")


@_query
def mart_daily_financials(f: Frames) -> DataFrame:
    return f.daily


@_query
def assert_take_rate_band(f: Frames) -> DataFrame:
    return guards.take_rate_extremes(f.daily, f.params.take_rate)


@_query
def brand_month_spine(f: Frames) -> DataFrame:
    return mrr.brand_month_spine(f.subscriptions, f.raw.dim_date)


@_query
def brand_month_mrr(f: Frames) -> DataFrame:
    return mrr.brand_month_mrr(f.subscriptions, f.raw.dim_date)


@_query
def mrr_waterfall(f: Frames) -> DataFrame:
    return f.waterfall


@_query
def mrr_continuity_violations(f: Frames) -> DataFrame:
    return guards.broken_months(f.waterfall)


# Checks


@_query
def check_gmv_completeness(f: Frames) -> DataFrame:
    return checks.gmv_completeness(f.raw.raw_payments, f.raw.dim_brand, f.raw.dim_creator, f.daily)


@_query
def check_ledger_balance(f: Frames) -> DataFrame:
    return checks.ledger_balance(f.ledger, f.daily)


@_query
def check_mrr_invariant(f: Frames) -> DataFrame:
    return checks.mrr_invariant(f.waterfall)


@_query
def check_payout_discrepancy_rate(f: Frames) -> DataFrame:
    return checks.payout_discrepancy_rate(f.payouts, f.params.payout_discrepancy)


@_query
def check_unmatched_exist(f: Frames) -> DataFrame:
    return checks.unmatched_exist(f.unmatched)


@_query
def check_no_test_in_mart(f: Frames) -> DataFrame:
    return checks.no_test_in_mart(f.raw.raw_payments, f.ledger, f.payments)


@_query
def check_take_rate_range(f: Frames) -> DataFrame:
    return checks.take_rate_range(f.daily, f.params.take_rate)


@_query
def validation_report(f: Frames) -> DataFrame:
    run = RunFolder(f.spark, scratch_path(f.spark, "build"))
    raw = f.raw_tables
    full_build.stage_and_build(run, raw, f.params)
    # Failed checks are rows of the report; only publishing asks that there are none.
    full_build.file_report(f.spark, run, raw, dt.datetime.now(dt.timezone.utc), f.params)
    return checks.latest_report(f.spark, full_build.reports_of(run)).select(
        "name",
        "status",
        # Maps have no order; the text lists the figures by name.
        F.to_json(F.map_from_entries(F.sort_array(F.map_entries("detail")))).alias("detail"),
        F.col("summary.total").alias("total"),
        F.col("summary.passed").alias("passed"),
        F.col("summary.failed").alias("failed"),
    )


# Repeated loads


@_query
def insert_absent_subscriptions(f: Frames) -> DataFrame:
    """Spans known on a day, then all spans, then all again: a stored subscription stays as it was first loaded."""
    table = KeyedTable(f.spark, scratch_path(f.spark, "subscriptions"), ["subscription_id"], f.subscriptions.schema)
    early = subs.stage_subscriptions(f.resolved.where(F.col("event_date") < F.lit(EARLY_DAY)))
    for spans in (early, f.subscriptions, f.subscriptions):
        table.insert_absent(spans)
    return table.read()


@_query
def insert_absent_days(f: Frames) -> DataFrame:
    """The calendar of the orders up to a day, then of all orders: days are added at both ends and none twice."""
    every = calendar.dim_date_around(f.raw.orders, "o_orderdate", 6, 16)
    table = KeyedTable(f.spark, scratch_path(f.spark, "days"), ["date_day"], every.schema, buckets=4)
    early = calendar.dim_date_around(f.raw.orders.where(F.col("o_orderdate") < F.lit(EARLY_DAY)), "o_orderdate", 2, 0)
    for days in (early, every):
        table.insert_absent(days)
    return table.read()


@_query
def streamed_subscriptions(f: Frames) -> DataFrame:
    """Subscriptions of the events as a stream of three batches, in which some rows come again and some far too late."""
    spark, events = f.spark, f.raw.raw_subscription_events
    arriving, out, checkpoint = (scratch_path(spark, name) for name in ("arriving", "streamed", "stream"))
    early, again, late = (F.expr(x) for x in ("year(event_at) <= 1994", "event_id % 10 = 4", "event_id % 50 = 6"))
    for batch in (early & ~late, ~early | again, late):
        events.where(batch).write.mode("append").parquet(arriving)
        stream = intake.event_stream(spark, arriving)
        streaming.start_staging(stream, out, checkpoint, "30 days").awaitTermination()
    return streaming.staged_subscriptions(spark, out, f.raw.dim_brand, f.params.as_of)


@_query
def refresh_daily_financials(f: Frames) -> DataFrame:
    """The daily mart after some payments arrived late, and which of its days were rebuilt."""
    table = refresh.daily_table(f.spark, scratch_path(f.spark, "daily"), f.daily.schema)
    refresh.refresh_daily(table, f.ledger.where(~F.expr(LATE_PAYMENT)))
    touched = refresh.refresh_daily(table, f.ledger).select(F.col("entry_date").alias("touched"))
    rebuilt = table.read().join(touched, F.col("entry_date") == F.col("touched"), "left")
    return rebuilt.withColumn("rebuilt", F.col("touched").isNotNull()).drop("touched")


@_query
def refresh_mrr_waterfall(f: Frames) -> DataFrame:
    """The waterfall after the subscriptions of some brands were corrected, and which brand groups were rebuilt."""
    table = refresh.waterfall_table(f.spark, scratch_path(f.spark, "waterfall"), f.waterfall.schema)
    corrected = F.when(F.col("brand_id") % 50 == 7, F.col("mrr_cents") + 1).otherwise(F.col("mrr_cents"))
    refresh.refresh_waterfall(table, f.subscriptions.withColumn("mrr_cents", corrected), f.raw.dim_date)
    touched = refresh.refresh_waterfall(table, f.subscriptions, f.raw.dim_date).select(F.col("brand_group").alias("touched"))
    rebuilt = table.read().join(touched, F.col("brand_group") == F.col("touched"), "left")
    return rebuilt.withColumn("rebuilt", F.col("touched").isNotNull()).drop("touched", "brand_group")


# Reports


@_query
def monthly_financials(f: Frames) -> DataFrame:
    return reports.monthly_financials(f.daily)


@_query
def monthly_mrr_waterfall(f: Frames) -> DataFrame:
    return reports.monthly_mrr_waterfall(f.waterfall)


@_query
def net_revenue_retention(f: Frames) -> DataFrame:
    return reports.net_revenue_retention(f.waterfall)


@_query
def cohort_retention(f: Frames) -> DataFrame:
    return reports.cohort_retention(f.waterfall)


@_query
def cohort_matrix(f: Frames) -> DataFrame:
    return reports.cohort_matrix(reports.cohort_retention(f.waterfall))


@_query
def quarantine_breakdown(f: Frames) -> DataFrame:
    return reports.quarantine_breakdown(f.unmatched)


@_query
def gmv_kpis(f: Frames) -> DataFrame:
    return reports.gmv_kpis(reports.monthly_financials(f.daily))


@_query
def mrr_kpis(f: Frames) -> DataFrame:
    return reports.mrr_kpis(reports.monthly_mrr_waterfall(f.waterfall))


# Audits


class _Tables(Mapping):
    """The audited tables by name; a table is derived when it is asked for."""

    def __init__(self, f: Frames):
        raw = f.raw
        self._plans: dict[str, Callable[[], DataFrame]] = {
            "dim_date": lambda: raw.dim_date,
            "dim_brand": lambda: raw.dim_brand,
            "dim_creator": lambda: raw.dim_creator,
            "raw_subscription_events": lambda: raw.raw_subscription_events,
            "raw_campaigns": lambda: f.campaigns,
            "raw_payments": lambda: raw.raw_payments,
            "raw_payouts": lambda: raw.raw_payout_amounts,
            "stg_subscriptions": lambda: f.subscriptions,
            "stg_subscription_source_arrays": lambda: f.source_arrays,
            "stg_unmatched_events": lambda: with_row_key(f.unmatched, "unmatched_id"),
            "stg_ledger_entries": lambda: with_row_key(f.ledger, "ledger_id"),
            "mart_daily_financials": lambda: f.daily,
            "mart_monthly_subscriptions": lambda: f.waterfall,
        }

    def __getitem__(self, name: str) -> DataFrame:
        return self._plans[name]()

    def __contains__(self, name: object) -> bool:
        return name in self._plans

    def __iter__(self) -> Iterator[str]:
        return iter(self._plans)

    def __len__(self) -> int:
        return len(self._plans)


@_query
def audit_not_null(f: Frames) -> DataFrame:
    return audits.audit_not_null(_Tables(f))


@_query
def audit_domain(f: Frames) -> DataFrame:
    return audits.audit_domain(_Tables(f))


@_query
def audit_observed(f: Frames) -> DataFrame:
    """NULLs, values outside their domain and texts too long, counted by a whole build while it writes its tables."""
    run = RunFolder(f.spark, scratch_path(f.spark, "build"))
    raw = full_build.load(run, f.raw_tables)
    full_build.stage_and_build(run, raw, f.params)
    return audits.audit_observed(f.spark, run.figures)


@_query
def audit_unique(f: Frames) -> DataFrame:
    return audits.audit_unique(_Tables(f))


@_query
def audit_unique_bitmaps(f: Frames) -> DataFrame:
    """The integer keys of the raw payments and payouts, counted in bitmaps."""
    return audits.audit_unique({name: _Tables(f)[name] for name in NUMBERED_TABLES}, audits.NUMBERED)


@_query
def audit_foreign_keys_bitmaps(f: Frames) -> DataFrame:
    """The payments that raw payouts name, compared in bitmaps."""
    return audits.audit_foreign_keys({name: _Tables(f)[name] for name in NUMBERED_TABLES}, audits.NUMBERED)


@_query
def audit_length(f: Frames) -> DataFrame:
    return audits.audit_length(_Tables(f))


@_query
def audit_foreign_keys(f: Frames) -> DataFrame:
    return audits.audit_foreign_keys(_Tables(f))


@_query
def anomaly_profile(f: Frames) -> DataFrame:
    raw = f.raw
    return audits.anomaly_profile(raw.raw_subscription_events, raw.raw_payments, raw.raw_payout_amounts, raw.dim_brand)


@_query
def fee_audit(f: Frames) -> DataFrame:
    return audits.fee_audit(f.raw.raw_payments, f.raw.raw_payout_amounts, f.params.fees)


_NAMES = {"load_raw_payments": "load_raw"}
# Queries that read a derived table several times, as a whole.
_WIDE = {"insert_absent_subscriptions", "refresh_mrr_waterfall"}


def queries() -> dict[str, Query]:
    """Every query by name, each taking a session and a folder."""

    def bound(name: str, build: Callable[[Frames], DataFrame]) -> Query:
        frames = StoredFrames if name in _WIDE else Frames
        return lambda spark, folder: _flat(build(frames(spark, folder)))

    return {_NAMES.get(name, name): bound(name, build) for name, build in _QUERIES.items()}
