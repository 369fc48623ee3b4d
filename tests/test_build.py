import datetime as dt

import pytest
from pyspark.sql import functions as F

import rows
from ledgerloom.operators import checks, guards
from ledgerloom.operators.quarantine import quarantine_ghost_brand, quarantine_missing_brand
from ledgerloom.operators.subscriptions import dedup_events
from ledgerloom.plans import build as plans
from ledgerloom.plans.frames import Frames
from ledgerloom.sources.files import write_raw
from ledgerloom.sources.tables import RunFolder
from ledgerloom.streaming import intake

UTC = dt.timezone.utc
AS_OF = dt.datetime(2002, 12, 31, tzinfo=UTC)


def test_build_publishes_and_a_failed_build_changes_nothing(spark, folder, tmp_path):
    raw = Frames(spark, folder).raw_tables
    root = str(tmp_path / "out")
    run = plans.build(spark, raw, root, AS_OF)
    with pytest.raises(RuntimeError, match="checks"):
        run.publish("finance", plans.PUBLIC_TABLES)
    results = plans.validate(spark, run, raw, dt.datetime(2024, 1, 1, tzinfo=UTC))
    assert {(r.name, r.status) for r in results.collect()} == {(f"V{i}", "pass") for i in range(1, 8)}
    run.publish("finance", plans.PUBLIC_TABLES)
    assert spark.table("finance.stg_subscriptions").count() == 492
    assert spark.table("finance.stg_payments").count() == 1_461
    assert spark.table("finance.mart_monthly_subscriptions").count() == 11_840
    listed = spark.table("finance.stg_subscription_source_arrays").agg(F.sum(F.size("event_ids"))).first()[0]
    assert listed == spark.table("finance.stg_subscription_sources").count()
    before = rows.plain(spark.table("finance.mart_daily_financials"))

    greedy = raw.payments.withColumn("platform_fee_cents", F.col("platform_fee_cents") * 3)
    with pytest.raises(guards.InvariantError, match="take rate"):
        plans.build(spark, plans.RawTables(**{**raw.__dict__, "payments": greedy}), root, AS_OF)
    assert rows.plain(spark.table("finance.mart_daily_financials")) == before

    # Nothing unmatched: V5 fails, its report is filed, and every table stays with the old run.
    failing = plans.build(spark, raw, root, AS_OF)
    failing.tables["stg_unmatched_events"] = failing.tables["stg_unmatched_events"].limit(0)
    with pytest.raises(guards.CheckError, match="V5"):
        plans.validate(spark, failing, raw, dt.datetime(2024, 1, 3, tzinfo=UTC))
    with pytest.raises(RuntimeError, match="checks"):
        failing.publish("finance", plans.PUBLIC_TABLES)
    assert spark.table("finance.current_run").first()["run_id"] == run.run_id
    latest = checks.latest_report(spark, plans.reports_of(run)).collect()
    assert {r.name for r in latest if r.status == "fail"} == {"V5"}

    again = plans.build(spark, raw, root, AS_OF)
    latest = plans.validate(spark, again, raw, dt.datetime(2024, 1, 2, tzinfo=UTC)).collect()
    assert {r.generated_at.year for r in latest} == {2024} and any(r.status == "fail" for r in latest)  # that of January 3
    again.publish("finance", plans.PUBLIC_TABLES)
    assert spark.table("finance.current_run").first()["run_id"] == again.run_id
    assert rows.plain(spark.table("finance.mart_daily_financials")) == before


def test_a_publish_that_breaks_off_mixes_no_runs(spark, folder, tmp_path):
    root = str(tmp_path / "out")
    old, new = RunFolder(spark, root), RunFolder(spark, root)
    for run, value in ((old, 1), (new, 2)):
        for name in ("a", "b"):
            run.keep(name, spark.range(1).select(F.lit(value).alias("v")))
        run.checked = True
    old.publish("halves")
    new._point = lambda current: (_ for _ in ()).throw(OSError("stopped"))
    with pytest.raises(OSError):
        new.publish("halves")
    assert [spark.table(f"halves.{n}").first()["v"] for n in "ab"] == [1, 1]
    del new._point
    new.publish("halves")
    assert [spark.table(f"halves.{n}").first()["v"] for n in "ab"] == [2, 2]


def test_events_far_from_the_others_keep_their_months(spark, folder, tmp_path):
    raw = Frames(spark, folder).raw_tables
    late = raw.events.where("event_type = 'subscription_created' AND brand_external_id <> 'BRD-GHOST'").limit(1)
    late = late.withColumn("event_id", F.lit(10**12)).withColumn("raw_event_id", F.lit("late"))
    late = late.withColumn("plan_name", F.lit("late")).withColumn("event_at", F.to_timestamp(F.lit("2030-05-10 00:00:00")).cast(raw.events.schema["event_at"].dataType))
    tables = {**raw.__dict__, "events": raw.events.unionByName(late), "calendar": None}
    run = RunFolder(spark, str(tmp_path))
    plans.stage(run, plans.RawTables(**tables))
    plans.build_marts(run, plans.RawTables(**tables))
    starts = run.tables["stg_subscriptions"].agg(F.max("start_date")).first()[0]
    assert starts == dt.date(2030, 5, 10)
    fixed = plans.RawTables(**{**tables, "calendar": raw.calendar})
    other = RunFolder(spark, str(tmp_path))
    other.tables = dict(run.tables)
    with pytest.raises(guards.InvariantError, match="calendar"):
        plans.build_marts(other, fixed)


def test_the_build_sets_the_zone_itself(spark, folder, tmp_path):
    raw = Frames(spark, folder).raw_tables
    expected = rows.plain(Frames(spark, folder).daily)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    run = plans.build(spark, raw, str(tmp_path), AS_OF)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert rows.plain(run.tables["mart_daily_financials"]) == expected


def test_build_from_csv_files_gives_the_same_marts(spark, folder, tmp_path):
    frames = Frames(spark, folder)
    raw, files = frames.raw_tables, str(tmp_path / "csv")
    by_name = {
        "raw_subscription_events": raw.events,
        "raw_payments": raw.payments,
        "raw_payouts": raw.payouts,
        "dim_brand": raw.brands,
        "dim_creator": raw.creators,
    }
    for name, df in by_name.items():
        write_raw(df, f"{files}/{name}")
    run = RunFolder(spark, str(tmp_path / "out"))
    loaded = plans.load(run, plans.read_raw(spark, files), {"payments": 1_500, "events": 1_530})
    plans.stage(run, loaded)
    plans.build_marts(run, loaded)
    assert rows.plain(run.tables["mart_daily_financials"]) == rows.plain(frames.daily)
    assert rows.plain(run.tables["mart_monthly_subscriptions"]) == rows.plain(frames.waterfall)
    spans = run.tables["stg_subscriptions"]
    listed = run.tables["stg_subscription_source_arrays"].groupBy("subscription_id").agg(F.sum(F.size("event_ids")).alias("n"))
    assert spans.join(listed, "subscription_id").where("n = source_event_count").count() == spans.count()
    with pytest.raises(guards.InvariantError, match="1501 expected"):
        plans.load(RunFolder(spark, str(tmp_path / "again")), plans.read_raw(spark, files), {"payments": 1_501})


def test_empty_ledger_stops_the_build(spark, folder, tmp_path):
    raw = Frames(spark, folder).raw_tables
    none_live = raw.payments.withColumn("status", F.lit("failed"))
    with pytest.raises(guards.InvariantError, match="ledger"):
        plans.stage(RunFolder(spark, str(tmp_path)), plans.RawTables(**{**raw.__dict__, "payments": none_live}))


def test_streamed_events_equal_the_batch(spark, folder, tmp_path):
    raw = Frames(spark, folder).raw
    events = raw.raw_subscription_events.withColumn("event_at", F.col("event_at").cast("timestamp"))
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema_order = events.columns

    def arrive(part):
        part.select(*schema_order).repartition(3).write.mode("append").parquet(source)

    def drain():
        stream = intake.event_stream(spark, source, files_per_batch=2)
        intake.start_intake(stream, raw.dim_brand, out, str(tmp_path / "checkpoint")).awaitTermination()

    # Late events arrive in the second wave, copies in the first.
    late = F.col("event_at") < "1997-01-01"
    arrive(events.where(~late))
    drain()
    arrive(events.where(late))
    drain()
    drain()  # nothing new
    known = dedup_events(events).join(raw.dim_brand.select("brand_external_id"), "brand_external_id", "left_semi")
    got = intake.accepted_events(spark, out).select(*schema_order)
    assert rows.plain(got) == rows.plain(known.select(*schema_order))
    bad = quarantine_missing_brand(events).unionByName(quarantine_ghost_brand(events, raw.dim_brand))
    assert rows.plain(intake.unmatched_events(spark, out)) == rows.plain(bad)
