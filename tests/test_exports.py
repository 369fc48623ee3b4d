import pytest
from pyspark.sql import functions as F

import rows
from ledgerloom.operators import guards
from ledgerloom.plans import build as plans
from ledgerloom.plans import exports
from ledgerloom.plans.frames import Frames
from ledgerloom.sources.files import write_raw
from ledgerloom.sources.schemas import EXPORTS
from ledgerloom.sources.tables import RunFolder


def columns_of(schema):
    return [part.split()[0] for part in schema.split(", ")]


@pytest.fixture
def given(spark, folder):
    raw = Frames(spark, folder).raw
    payment_ref = "'PAY-' || payment_id AS payment_ref"
    tables = {
        "events": raw.raw_subscription_events,
        "campaigns": raw.campaign_requests,
        "payments": raw.raw_payments.selectExpr("*", payment_ref, "'CMP-' || lpad(campaign_id, 9, '0') AS campaign_ref"),
        "payouts": raw.raw_payouts.selectExpr("*", "'OUT-' || payout_id AS payout_ref", payment_ref),
        "brands": raw.dim_brand,
        "creators": raw.dim_creator,
    }
    return exports.Exports(**{name: df.select(*columns_of(EXPORTS[name])) for name, df in tables.items()})


def test_exports_with_external_ids_only_give_the_same_marts(spark, folder, given, tmp_path):
    for name, df in given.__dict__.items():
        write_raw(df, str(tmp_path / "csv" / name))
    run = RunFolder(spark, str(tmp_path / "out"))
    loaded, summary = exports.load_exports(run, exports.read_exports(spark, str(tmp_path / "csv")))
    plans.stage(run, loaded)
    plans.build_marts(run, loaded)
    frames = Frames(spark, folder)
    assert rows.plain(run.tables["mart_daily_financials"]) == rows.plain(frames.daily)

    def by_brand(waterfall, brands):
        return rows.plain(waterfall.join(brands.select("brand_id", "brand_external_id"), "brand_id").drop("brand_id"))

    assert by_brand(run.tables["mart_monthly_subscriptions"], loaded.brands) == by_brand(frames.waterfall, frames.raw.dim_brand)
    counts = {r.table_name: r for r in summary.collect()}
    assert counts["raw_payments"].skipped == counts["raw_subscription_events"].skipped == 0
    assert counts["raw_campaigns"].skipped == given.campaigns.count() - run.tables["raw_campaigns"].count() > 0


def test_unknown_payments_are_skipped_and_repeated_ids_refused(spark, given, tmp_path):
    lost = F.when(F.col("payout_ref").endswith("7"), F.lit("PAY-none")).otherwise(F.col("payment_ref"))
    changed = exports.Exports(**{**given.__dict__, "payouts": given.payouts.withColumn("payment_ref", lost)})
    _, summary = exports.load_exports(RunFolder(spark, str(tmp_path / "a")), changed)
    skipped = {r.table_name: r.skipped for r in summary.collect()}["raw_payouts"]
    assert skipped == given.payouts.where("payout_ref LIKE '%7'").count() > 0
    twice = exports.Exports(**{**given.__dict__, "brands": given.brands.unionByName(given.brands)})
    with pytest.raises(guards.InvariantError, match="brand_external_id"):
        exports.load_exports(RunFolder(spark, str(tmp_path / "b")), twice)
