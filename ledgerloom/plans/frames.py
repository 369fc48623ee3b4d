"""Lazy staged tables and marts over one folder of raw data."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.operators import financials, ledger, loading, mrr, payments, quarantine, subscriptions
from ledgerloom.params import DEFAULTS, Params
from ledgerloom.plans.build import RawTables
from ledgerloom.session import prepare, scratch_path
from ledgerloom.sources.marketplace import Marketplace
from ledgerloom.sources.tables import RunFolder


class Frames:
    """Every table as the plan that derives it from the raw files.

    Nothing is cached or shared between queries: each action plans and runs
    only what its own columns need.
    """

    def __init__(self, spark: SparkSession, folder: str, params: Params = DEFAULTS):
        self.spark = prepare(spark)
        self.params = params
        self.raw = Marketplace(spark, folder, params)

    @property
    def raw_tables(self) -> RawTables:
        raw = self.raw
        return RawTables(
            raw.raw_subscription_events,
            raw.raw_payments,
            raw.raw_payouts,
            raw.dim_brand,
            raw.dim_creator,
            raw.dim_date,
        )

    @cached_property
    def campaigns(self) -> DataFrame:
        return loading.resolve_campaign_keys(self.raw.campaign_requests, self.raw.dim_brand, self.raw.dim_creator)

    @cached_property
    def resolved(self) -> DataFrame:
        return subscriptions.resolved_events(
            self.raw.raw_subscription_events, self.raw.dim_brand, self.params.as_of
        )

    @cached_property
    def subscriptions(self) -> DataFrame:
        return subscriptions.stage_subscriptions(self.resolved)

    @cached_property
    def source_arrays(self) -> DataFrame:
        return subscriptions.source_array_parts(subscriptions.subscription_sources(self.resolved))

    @cached_property
    def payments(self) -> DataFrame:
        return payments.stage_payments(self.raw.raw_payments, self.raw.dim_brand, self.raw.dim_creator)

    @cached_property
    def payouts(self) -> DataFrame:
        return payments.stage_payouts(self.raw.raw_payouts, self.payments, self.raw.dim_creator)

    @cached_property
    def unmatched(self) -> DataFrame:
        raw = self.raw
        keyed = payments.with_entity_keys(raw.raw_payments, raw.dim_brand, raw.dim_creator)
        return quarantine.unmatched_rows(raw.raw_subscription_events, keyed, raw.dim_brand)

    @cached_property
    def ledger(self) -> DataFrame:
        return ledger.ledger_entries(self.payments, self.raw.raw_payout_amounts)

    @cached_property
    def daily(self) -> DataFrame:
        return financials.daily_financials(self.ledger)

    @cached_property
    def waterfall(self) -> DataFrame:
        return mrr.mrr_waterfall(self.subscriptions, self.raw.dim_date)


class StoredFrames(Frames):
    """The same tables; events and spans are derived once, on first use, and read back by all that need them.

    For results that read the spans three times or more. The files lie in one
    folder under the shared scratch root, to be removed by its owner.
    """

    def __init__(self, spark: SparkSession, folder: str, params: Params = DEFAULTS):
        super().__init__(spark, folder, params)
        self.run = RunFolder(spark, scratch_path(spark, "stored"))

    @cached_property
    def resolved(self) -> DataFrame:
        return self.run.keep("resolved", Frames.resolved.func(self))

    @cached_property
    def subscriptions(self) -> DataFrame:
        return self.run.keep("subscriptions", Frames.subscriptions.func(self))
