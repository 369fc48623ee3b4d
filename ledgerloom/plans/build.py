"""The whole build: stage, fan out, aggregate, audit, publish."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, fields, replace
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.branches import run_together
from ledgerloom.functions.keys import with_row_key
from ledgerloom.operators import audits, checks, financials, guards, ledger, mrr, payments, quarantine, subscriptions
from ledgerloom.operators.calendar import calendar_of, dim_date
from ledgerloom.params import DEFAULTS, Params
from ledgerloom.session import prepare
from ledgerloom.sources.files import load_raw
from ledgerloom.sources.schemas import RAW_TABLES
from ledgerloom.sources.tables import RunFolder

PUBLIC_TABLES = [
    "stg_subscriptions",
    "stg_subscription_sources",
    "stg_subscription_source_arrays",
    "stg_payments",
    "stg_payouts",
    "stg_unmatched_events",
    "stg_ledger_entries",
    "mart_daily_financials",
    "mart_monthly_subscriptions",
]


@dataclass(frozen=True)
class RawTables:
    events: DataFrame
    payments: DataFrame
    payouts: DataFrame
    brands: DataFrame
    creators: DataFrame
    # None: the calendar follows from the spans.
    calendar: DataFrame | None = None


def read_raw(spark: SparkSession, folder: str, params: Params = DEFAULTS) -> RawTables:
    """The raw tables of a folder with one subfolder of CSV files for each."""
    prepare(spark)

    def table(name: str) -> DataFrame:
        return load_raw(spark, f"{folder.rstrip('/')}/{name}", RAW_TABLES[name])

    return RawTables(
        table("raw_subscription_events"),
        table("raw_payments"),
        table("raw_payouts"),
        table("dim_brand"),
        table("dim_creator"),
        dim_date(spark, params.calendar_start, params.calendar_end) if params.calendar_start and params.calendar_end else None,
    )


# The audited names of the raw tables.
AUDITED_AS = {
    "events": "raw_subscription_events",
    "payments": "raw_payments",
    "payouts": "raw_payouts",
    "brands": "dim_brand",
    "creators": "dim_creator",
    "calendar": "dim_date",
}


def _keep(run: RunFolder, name: str, df: DataFrame, **more: Column) -> DataFrame:
    """Store a table; the counts of its rules are gathered in the same pass."""
    return run.keep(name, df, audits.rule_counts(name) | more)


def load(run: RunFolder, raw: RawTables, expected: Mapping[str, int] | None = None) -> RawTables:
    """Store the raw tables as parquet, so that every step reads typed columns.

    ``expected`` may give the rows a table must have received. They are counted while the tables are written, as are
    the rows that break the rules of a table (``run.figures``, by the audited name of the table).
    """
    prepare(run.spark)
    given = {f.name: getattr(raw, f.name) for f in fields(raw) if getattr(raw, f.name) is not None}

    def store(name: str) -> DataFrame:
        stored = run.keep(f"raw_{name}", given[name], audits.rule_counts(AUDITED_AS[name]))
        run.figures[AUDITED_AS[name]] = run.figures.pop(f"raw_{name}")
        return stored

    stored = RawTables(**run_together(run.spark, {name: partial(store, name) for name in given}))
    for name, rows in (expected or {}).items():
        loaded = run.figures[AUDITED_AS[name]]["rows"]
        if loaded != rows:
            raise guards.InvariantError(f"{name}: {loaded} rows loaded, {rows} expected")
    return stored


Step = Callable[[], None]


def _nothing() -> None:
    pass


def _stage_subscriptions(run: RunFolder, raw: RawTables, params: Params, then: Step = _nothing) -> None:
    """Spans and their sources; ``then`` begins as soon as the spans stand."""
    resolved = run.keep("resolved_events", subscriptions.resolved_events(raw.events, raw.brands, params.as_of))
    sources = run.keep("stg_subscription_sources", subscriptions.subscription_sources(resolved))

    def spans() -> None:
        made = subscriptions.with_source_counts(subscriptions.stage_subscriptions(resolved), sources)
        _keep(run, "stg_subscriptions", made)
        seen = run.figures["stg_subscriptions"]
        guards.require_none(seen["not_null:brand_id"], "subscriptions without a brand")
        guards.require_none(seen["not_null:start_date"], "subscriptions without a start date")
        then()

    def arrays() -> None:
        _keep(run, "stg_subscription_source_arrays", subscriptions.source_array_parts(sources))

    run_together(run.spark, {"spans": spans, "arrays": arrays})


def _stage_payments(run: RunFolder, raw: RawTables, params: Params, then: Step = _nothing) -> None:
    """Payments, payouts, quarantine and ledger; ``then`` begins as soon as the ledger stands."""

    def entries(made: DataFrame) -> None:
        _keep(run, "stg_ledger_entries", with_row_key(ledger.ledger_entries(made, raw.payouts), "ledger_id"))
        guards.require_rows(run.figures["stg_ledger_entries"]["rows"], "the ledger is empty: no live payment was staged")
        then()

    # Staging and quarantine both need the keys, so the two joins run once.
    keyed = run.keep("keyed_payments", payments.with_entity_keys(raw.payments, raw.brands, raw.creators))

    def quarantined() -> None:
        unmatched = with_row_key(quarantine.unmatched_rows(raw.events, keyed, raw.brands), "unmatched_id")
        _keep(run, "stg_unmatched_events", quarantine.with_quarantine_time(unmatched, params.as_of))

    def staged() -> None:
        is_mixed = F.count_if(F.col("status") != F.lower("status"))
        made = _keep(run, "stg_payments", payments.stage_keyed_payments(keyed), mixed_case=is_mixed)
        guards.require_none(run.figures["stg_payments"]["mixed_case"], "payment statuses that are not lower case")
        run_together(
            run.spark,
            {
                "payouts": lambda: _keep(run, "stg_payouts", payments.stage_payouts(raw.payouts, made, raw.creators)),
                "ledger": lambda: entries(made),
            },
        )

    run_together(run.spark, {"quarantine": quarantined, "payments": staged})


def stage(run: RunFolder, raw: RawTables, params: Params = DEFAULTS) -> None:
    """Write the staging tables and the ledger, what does not depend on each other side by side.

    Stops on a broken invariant. Guards look at figures gathered while the tables were written.
    """
    prepare(run.spark)
    run_together(
        run.spark,
        {
            "subscriptions": lambda: _stage_subscriptions(run, raw, params),
            "payments": lambda: _stage_payments(run, raw, params),
        },
    )


def _build_daily(run: RunFolder, params: Params) -> None:
    rates = {"low": F.min("take_rate_gross").cast("double"), "high": F.max("take_rate_gross").cast("double")}
    _keep(run, "mart_daily_financials", financials.daily_financials(run.tables["stg_ledger_entries"]), **rates)
    seen = run.figures["mart_daily_financials"]
    guards.require_rows(seen["rows"], "the daily mart is empty")
    low, high = seen["low"], seen["high"]
    if low is not None and (low < params.take_rate.low or high > params.take_rate.high):
        raise guards.InvariantError(f"gross take rate outside its band: {low} to {high}")


def _build_waterfall(run: RunFolder, raw: RawTables, params: Params) -> None:
    spans = run.tables["stg_subscriptions"]
    calendar = raw.calendar
    if calendar is None:
        calendar = calendar_of(spans, params.months_before, params.months_after)
    guards.require(guards.spans_outside(spans, calendar), "subscriptions outside the calendar")
    waterfall = _keep(run, "mart_monthly_subscriptions", mrr.mrr_waterfall(spans, calendar))
    guards.require_rows(run.figures["mart_monthly_subscriptions"]["rows"], "the monthly mart is empty")
    guards.require(guards.broken_months(waterfall), "months that do not continue each other", guards.ContinuityError)


def build_marts(run: RunFolder, raw: RawTables, params: Params = DEFAULTS) -> None:
    """Write both marts side by side; stop on a broken invariant."""
    run_together(
        run.spark, {"daily": lambda: _build_daily(run, params), "waterfall": lambda: _build_waterfall(run, raw, params)}
    )


def stage_and_build(run: RunFolder, raw: RawTables, params: Params = DEFAULTS) -> None:
    """:func:`stage` and :func:`build_marts` as two branches, each mart as soon as what it reads stands."""
    prepare(run.spark)
    run_together(
        run.spark,
        {
            "subscriptions": lambda: _stage_subscriptions(run, raw, params, lambda: _build_waterfall(run, raw, params)),
            "payments": lambda: _stage_payments(run, raw, params, lambda: _build_daily(run, params)),
        },
    )


def check_plans(run: RunFolder, raw: RawTables, params: Params = DEFAULTS) -> dict[str, Callable[[], DataFrame]]:
    """The reconciliation checks over the tables of a run."""
    t = run.tables
    return {
        "V1": lambda: checks.gmv_completeness(raw.payments, raw.brands, raw.creators, t["mart_daily_financials"]),
        "V2": lambda: checks.ledger_balance(t["stg_ledger_entries"], t["mart_daily_financials"]),
        "V3": lambda: checks.mrr_invariant(t["mart_monthly_subscriptions"]),
        "V4": lambda: checks.payout_discrepancy_rate(t["stg_payouts"], params.payout_discrepancy),
        "V5": lambda: checks.unmatched_exist(t["stg_unmatched_events"]),
        "V6": lambda: checks.no_test_in_mart(raw.payments, t["stg_ledger_entries"], t["stg_payments"]),
        "V7": lambda: checks.take_rate_range(t["mart_daily_financials"], params.take_rate),
    }


def build(
    spark: SparkSession, raw: RawTables, root: str, as_of: dt.datetime, params: Params = DEFAULTS
) -> RunFolder:
    """Stage and build all tables under ``root``; ``as_of`` is the time of the run.

    Check them with :func:`validate`, then show them with ``RunFolder.publish``.
    """
    prepare(spark)
    params = replace(params, as_of=as_of)
    run = RunFolder(spark, root)
    stage_and_build(run, raw, params)
    return run


def reports_of(run: RunFolder) -> str:
    """The folder with the reports of all runs under one root."""
    return f"{run.root}/reports"


def file_report(
    spark: SparkSession, run: RunFolder, raw: RawTables, generated_at: dt.datetime, params: Params = DEFAULTS
) -> list[str]:
    """Run all checks over a build, file the report with those of earlier runs and name the checks that failed."""
    prepare(spark)
    texts = checks.descriptions(params.payout_discrepancy, params.take_rate)
    results = checks.run_checks(spark, check_plans(run, raw, params), texts)
    checks.write_report(results, reports_of(run), generated_at)
    return [r["name"] for r in results.where(F.col("status") != "pass").orderBy("name").collect()]


def validate(
    spark: SparkSession, run: RunFolder, raw: RawTables, generated_at: dt.datetime, params: Params = DEFAULTS
) -> DataFrame:
    """Run all checks over a build and give the filed report.

    The report is filed either way; a failed check raises and leaves the run unpublishable.
    """
    failed = file_report(spark, run, raw, generated_at, params)
    if failed:
        raise guards.CheckError(f"checks failed: {', '.join(failed)}")
    run.checked = True
    return checks.latest_report(spark, reports_of(run))
