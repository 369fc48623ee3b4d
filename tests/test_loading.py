import datetime as dt

import pytest
from pyspark.sql import functions as F

import rows
from ledgerloom.functions.keys import with_dense_key, with_group_sequence
from ledgerloom.operators import audits, calendar, loading
from ledgerloom.operators import subscriptions as subs
from ledgerloom.params import Fees
from ledgerloom.sources import schemas
from ledgerloom.sources.files import load_raw, write_raw


def test_csv_round_trip_keeps_nulls_blanks_and_quotes(spark, tmp_path):
    data = [
        (1, None, None, 'CRT "x", y', 100, 10, 3, 0, " succeeded ", rows.at("2023-06-15T08:09:10.123456")),
        (2, 7, "", "a,b", 100, 10, 3, 0, "failed", rows.at("2023-06-15")),
    ]
    df = spark.createDataFrame(data, schemas.RAW_PAYMENTS)
    path = str(tmp_path / "csv")
    write_raw(df, path)
    back = load_raw(spark, path, schemas.RAW_PAYMENTS)
    assert back.schema.simpleString() == df.schema.simpleString()
    assert rows.plain(back) == rows.plain(df)
    assert load_raw(spark, path, schemas.RAW_PAYMENTS, ["status", "payment_id"]).columns == ["status", "payment_id"]


def test_csv_with_offsets_and_unquoted_empties(spark, tmp_path):
    file = tmp_path / "p.csv"
    file.write_text('1,,BRD-000001,,100,10,3,0,succeeded,2023-06-15T10:00:00+02:00\n')
    row = load_raw(spark, str(file), schemas.RAW_PAYMENTS).first()
    assert (row.campaign_id, row.creator_external_id) == (None, None)
    assert row.paid_at == dt.datetime(2023, 6, 15, 8)


def test_csv_that_does_not_fit_stops_the_load(spark, tmp_path):
    file = tmp_path / "p.csv"
    file.write_text("one,,BRD-000001,,100,10,3,0,succeeded,2023-06-15T10:00:00\n")
    with pytest.raises(Exception, match="MALFORMED|malformed|parse"):
        load_raw(spark, str(file), schemas.RAW_PAYMENTS).collect()


def test_dense_keys_are_one_to_n(spark):
    df = spark.range(5_000).select(F.concat(F.lit("id-"), "id").alias("ext")).repartition(7)
    keys = with_dense_key(df, "ext", "key")
    assert sorted(r.key for r in keys.collect()) == list(range(1, 5_001))
    assert rows.plain(with_dense_key(df.repartition(3), "ext", "key")) == rows.plain(keys)


@pytest.mark.parametrize("spread", [1, 1_000_003, -(2**49) - 1])
def test_group_sequence_is_cut_without_a_seam(spark, spread):
    df = spark.range(3_000).select(
        F.when(F.col("id") % 10 < 6, "hot").otherwise("cold").alias("g"), (F.col("id") * spread).alias("id")
    )
    got = with_group_sequence(df, "g", "id", "n", low_bits=6, high_bits=10 if spread == 1 else 42).collect()
    for group in ("hot", "cold"):
        ordered = sorted((r.id, r.n) for r in got if r.g == group)
        assert [n for _, n in ordered] == list(range(1, len(ordered) + 1))
        assert len(ordered) == (1_800 if group == "hot" else 1_200)


def test_event_ids_follow_the_text_rule(spark):
    import hashlib

    events = rows.events(
        spark,
        [
            (1, "a", "BRD-000001", "renewal", "p", "monthly", 1, "2023-01-02T03:04:05", False),
            (2, "b", "BRD-000001", "renewal", "p", "monthly", 1, "2023-01-02T03:04:05.000123", False),
        ],
    )
    ids = subs.raw_event_ids(events)
    texts = ["BRD-000001:renewal:2023-01-02T03:04:05+00:00:1", "BRD-000001:renewal:2023-01-02T03:04:05.000123+00:00:2"]
    assert [r.derived_event_id for r in ids.orderBy("event_id").collect()] == [
        hashlib.sha256(t.encode()).hexdigest()[:32] for t in texts
    ]
    clash = subs.event_id_collisions(events.withColumn("raw_event_id", F.lit("same")), "raw_event_id").first()
    assert tuple(clash) == (2, 1, 1, 1)


def test_campaigns_with_unknown_entities_are_skipped_and_counted(spark):
    schema = "campaign_ref STRING, campaign_id BIGINT, brand_external_id STRING, creator_external_id STRING"
    campaigns = spark.createDataFrame(
        [
            ("a", 1, "BRD-000001", "CRT-00000001"),
            ("b", 2, "BRD-GHOST", "CRT-00000001"),
            ("c", 3, "BRD-000001", None),
            ("d", 4, "BRD-000002", "CRT-00000001"),
        ],
        schema,
    )
    brands, creators = rows.brands(spark, 1, 2), rows.creators(spark, 1)
    kept = loading.resolve_campaign_keys(campaigns, brands, creators)
    assert rows.plain(kept.select("campaign_id", "brand_id", "creator_id")) == [(1, 1, 1), (4, 2, 1)]
    assert tuple(loading.campaign_load_summary(campaigns, brands, creators).first()) == (4, 2, 2)
    payments = spark.createDataFrame([(10, "a"), (11, "b"), (12, None)], "payment_id BIGINT, campaign_ref STRING")
    assert rows.plain(loading.attach_campaign_keys(payments, kept)) == [(10, 1), (11, None), (12, None)]


def test_row_counts_show_what_is_missing(spark):
    full, short = spark.range(5), spark.range(3)
    got = {r.table_name: tuple(r)[1:] for r in loading.load_row_counts({"a": full, "b": full}, {"a": full, "b": short}).collect()}
    assert got == {"a": (5, 5, True), "b": (5, 3, False)}


def test_calendar_days(spark):
    days = rows.calendar(spark)
    assert days.count() == 762
    by_day = {str(r.date_day): r for r in days.collect()}
    sunday = by_day["2023-01-01"]
    assert (sunday.week, sunday.day_of_week, sunday.is_weekend, sunday.quarter) == (52, 0, True, 1)
    leap = by_day["2024-02-10"]
    assert (str(leap.month_start), str(leap.month_end), leap.day_of_week) == ("2024-02-01", "2024-02-29", 6)
    again = calendar.dim_date(spark, dt.date(2024, 7, 30), dt.date(2024, 8, 2))
    assert sorted(str(r.date_day) for r in calendar.missing_days(again, days).collect()) == ["2024-08-01", "2024-08-02"]


def test_audits_find_each_fault(spark):
    raw = rows.raw_payments(
        spark,
        [
            (1, 1, "BRD-000001", None, 0, 10, 3, 0, "succeeded", "2023-01-01"),
            (1, None, "BRD-000001", None, 100, 10, 3, -1, "succeeded", "2023-01-01"),
            (2, 9, "BRD-000001", None, 100, None, 3, 0, "succeeded", "2023-01-01"),
        ],
    )
    brands = rows.brands(spark, 1).withColumn("brand_external_id", F.lit("BRD-" + "0" * 17)).withColumn("tier", F.lit("Huge"))
    campaigns = spark.createDataFrame([(1, 1, 1, 5, "active", None, None)], schemas.RAW_CAMPAIGNS)
    tables = {"raw_payments": raw, "dim_brand": brands, "raw_campaigns": campaigns}

    def broken(df, *names):
        return {tuple(r[n] for n in names): r for r in df.collect()}

    nulls = broken(audits.audit_not_null(tables), "table_name", "column_name")
    assert nulls["raw_payments", "platform_fee_cents"].violations == 1
    assert nulls["raw_campaigns", "created_at"].violations == 1
    domain = broken(audits.audit_domain(tables), "table_name", "column_name")
    assert domain["raw_payments", "amount_gross_cents"].violations == 1
    assert domain["raw_payments", "amount_refunded_cents"].violations == 1
    assert domain["raw_payments", "platform_fee_cents"].violations == 0
    assert domain["dim_brand", "tier"].violations == 1
    unique = broken(audits.audit_unique(tables), "table_name", "key_columns")
    assert tuple(unique["raw_payments", "payment_id"])[2:] == (3, 1, 1)
    assert audits.audit_length(tables).first().violations == 1
    keys = broken(audits.audit_foreign_keys(tables), "foreign_key")
    assert tuple(keys["raw_payments.campaign_id",])[2:] == (1, 1)


def test_fee_audit_counts_a_payment_once(spark):
    gross = 12_345  # 2.9 % is 358.005
    raw = rows.raw_payments(
        spark,
        [
            (1, 1, None, None, gross, 1_234, 388, 0, "succeeded", "2023-01-03"),
            (2, 1, None, None, 250, 26, 37, 0, "succeeded", "2023-01-09"),
        ],
    )
    outs = rows.raw_payouts(
        spark,
        [(1, 1, None, 10_723, 1, "paid", "2023-01-05"), (2, 1, None, 10_722, 1, "paid", "2023-01-05"),
         (3, 2, None, 188, 1, "paid", "2023-01-05")],
    )
    row = audits.fee_audit(raw, outs, Fees()).first()
    assert (row.payments, row.gross_cents) == (2, gross + 250)
    # 10 % of 12 345 is 1 234.5: halves round to even.
    assert (row.due_platform_fee_cents, row.platform_fee_differs) == (1_234 + 25, 1)
    assert (row.processor_fee_differs, row.expected_payout_differs) == (0, 1)
