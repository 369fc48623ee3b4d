"""Loading of raw exports, which know brands, creators, campaigns and payments by external ids only."""

from __future__ import annotations

from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.keys import with_dense_key
from ledgerloom.operators import guards, loading
from ledgerloom.plans.build import RawTables
from ledgerloom.session import prepare
from ledgerloom.sources.files import load_raw
from ledgerloom.sources.schemas import EXPORTS
from ledgerloom.sources.tables import RunFolder


@dataclass(frozen=True)
class Exports:
    """Tables as exported; see ``sources.schemas.EXPORTS`` for their columns."""

    events: DataFrame
    campaigns: DataFrame
    payments: DataFrame
    payouts: DataFrame
    brands: DataFrame
    creators: DataFrame


def read_exports(spark: SparkSession, folder: str) -> Exports:
    """The exports of a folder with one subfolder of CSV files for each."""
    prepare(spark)
    root = folder.rstrip("/")
    return Exports(**{f.name: load_raw(spark, f"{root}/{f.name}", EXPORTS[f.name]) for f in fields(Exports)})


def _unique(df: DataFrame, column: str) -> DataFrame:
    """One row with the number of missing and repeated values of a column."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(F.count_if(F.col(column).isNull() | (F.col("n") > 1)).alias("violations"))


def load_exports(run: RunFolder, given: Exports) -> tuple[RawTables, DataFrame]:
    """Give every row its key, resolve what refers to it, and store the results in the run.

    Brands, creators, campaigns, payments and payouts are numbered by their
    external ids, which must be unique. Campaigns of an unknown brand or creator
    and payouts of an unknown payment are skipped; a payment whose campaign is
    unknown keeps no campaign and so counts as a test. Returns the tables and
    how many rows of each were received, loaded and skipped.
    """
    prepare(run.spark)
    for df, column in (
        (given.brands, "brand_external_id"),
        (given.creators, "creator_external_id"),
        (given.campaigns, "campaign_ref"),
        (given.payments, "payment_ref"),
        (given.payouts, "payout_ref"),
    ):
        guards.require(_unique(df, column), f"{column} is missing or repeated")
    brands = run.keep("dim_brand", with_dense_key(given.brands, "brand_external_id", "brand_id"))
    creators = run.keep("dim_creator", with_dense_key(given.creators, "creator_external_id", "creator_id"))
    campaigns = loading.resolve_campaign_keys(given.campaigns, brands, creators)
    campaigns = run.keep("raw_campaigns", with_dense_key(campaigns, "campaign_ref", "campaign_id"))
    payments = with_dense_key(given.payments, "payment_ref", "payment_id")
    payments = run.keep("raw_payments", loading.attach_campaign_keys(payments, campaigns))
    payouts = loading.attach_payment_keys(given.payouts, payments)
    payouts = run.keep("raw_payouts", with_dense_key(payouts, "payout_ref", "payout_id").drop("payout_ref"))
    # Copies of an event are equal in every column, so rows are numbered as they are stored, once.
    events = run.keep("raw_subscription_events", given.events.withColumn("event_id", F.monotonically_increasing_id()))
    counts = [
        loading.row_count(source, "received")
        .select(F.lit(name).alias("table_name"), "received", loading.row_count(loaded, "loaded").scalar().alias("loaded"))
        .withColumn("skipped", F.col("received") - F.col("loaded"))
        for name, source, loaded in (
            ("dim_brand", given.brands, brands),
            ("dim_creator", given.creators, creators),
            ("raw_campaigns", given.campaigns, campaigns),
            ("raw_payments", given.payments, payments),
            ("raw_payouts", given.payouts, payouts),
            ("raw_subscription_events", given.events, events),
        )
    ]
    summary = run.keep("load_summary", reduce(DataFrame.unionByName, counts))
    return RawTables(events, payments.drop("payment_ref"), payouts, brands, creators), summary
