import decimal

import pytest

import rows
from ledgerloom.functions import keys
from ledgerloom.operators import financials, guards, ledger

PAYMENT = (1, 100_000, 10_000, 3_200, 0, "succeeded", "2023-06-15", False)
PAYOUT = (9, 1, "CRT-00000001", 86_800, 86_800, "paid", "2023-06-25")


def entries(spark, payments, payouts):
    df = ledger.ledger_entries(rows.staged_payments(spark, payments), rows.raw_payouts(spark, payouts))
    return sorted((r.entry_type, r.amount_cents, str(r.entry_date)) for r in df.collect())


def test_payment_without_refund_gives_four_entries(spark):
    assert entries(spark, [PAYMENT], [PAYOUT]) == [
        ("brand_charge", 100_000, "2023-06-15"),
        ("creator_payout", -86_800, "2023-06-25"),
        ("platform_fee_revenue", 10_000, "2023-06-15"),
        ("stripe_processing_fee", -3_200, "2023-06-15"),
    ]


def test_refund_adds_a_fifth_entry(spark):
    refunded = (*PAYMENT[:4], 20_000, *PAYMENT[5:])
    got = entries(spark, [refunded], [PAYOUT])
    assert len(got) == 5 and ("refund_adjustment", -20_000, "2023-06-15") in got


def test_only_live_payments_and_paid_payouts_count(spark):
    payments = [
        (1, 10, 1, 1, 0, "failed", "2023-01-01", False),
        (2, 10, 1, 1, 0, "succeeded", "2023-01-01", True),
        (3, 10, 1, 1, 0, "Refunded", "2023-01-01", False),
    ]
    payouts = [
        (1, 1, None, 5, 5, "paid", "2023-01-02"),
        (2, 2, None, 5, 5, "paid", "2023-01-02"),
        (3, 3, None, 5, 5, "failed", "2023-01-02"),
        (4, 3, None, 5, 5, "pending", "2023-01-02"),
    ]
    assert [e[0] for e in entries(spark, payments, payouts)] == [
        "brand_charge",
        "platform_fee_revenue",
        "stripe_processing_fee",
    ]


def test_two_payouts_of_one_payment_do_not_double_its_charge(spark):
    again = (10, *PAYOUT[1:])
    kinds = [e[0] for e in entries(spark, [PAYMENT], [PAYOUT, again])]
    assert kinds.count("creator_payout") == 2 and kinds.count("brand_charge") == 1


def test_null_amounts_stay_in_the_ledger(spark):
    missing = (1, None, 1, 1, 0, "succeeded", "2023-01-01", False)
    assert ("brand_charge", None, "2023-01-01") in entries_with_nulls(spark, [missing])


def entries_with_nulls(spark, payments):
    df = ledger.ledger_entries(rows.staged_payments(spark, payments), rows.raw_payouts(spark, [PAYOUT]))
    return [(r.entry_type, r.amount_cents, str(r.entry_date)) for r in df.collect()]


def test_daily_totals_and_rates(spark):
    refunded = (*PAYMENT[:4], 20_000, *PAYMENT[5:])
    df = financials.daily_financials(
        ledger.ledger_entries(rows.staged_payments(spark, [refunded]), rows.raw_payouts(spark, [PAYOUT]))
    )
    charge, payout = sorted(df.collect(), key=lambda r: r.entry_date)
    assert (charge.gmv_cents, charge.net_gmv_cents, charge.platform_revenue_cents) == (100_000, 80_000, 10_000)
    assert (charge.stripe_fees_cents, charge.creator_payouts_cents, charge.gross_margin_cents) == (3_200, 0, 6_800)
    assert (charge.take_rate_gross, charge.take_rate_net) == (decimal.Decimal("0.1"), decimal.Decimal("0.125"))
    # A day of payouts alone has no volume and so no rate.
    assert (payout.gmv_cents, payout.gross_margin_cents) == (0, -86_800)
    assert payout.take_rate_gross is None and payout.take_rate_net is None


def test_take_rate_band(spark):
    def extremes(platform):
        payment = (1, 100_000, platform, 0, 0, "succeeded", "2023-06-15", False)
        entries_ = ledger.ledger_entries(rows.staged_payments(spark, [payment]), rows.raw_payouts(spark, [PAYOUT]))
        return guards.take_rate_extremes(financials.daily_financials(entries_), guards.Band(0.05, 0.20))

    guards.require(extremes(20_000), "band")
    with pytest.raises(guards.InvariantError):
        guards.require(extremes(20_001), "band")


def test_row_keys_tell_equal_rows_apart_and_do_not_depend_on_how_rows_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(keys, "RUN_ROWS", 7)
    made = [(1, "a", None), (1, "a", None), (1, None, "a"), (None, "1|a", ""), (11, "", "a")] + [(2, "hot", "x")] * 50
    df = spark.createDataFrame(made, "n int, a string, b string")
    once = rows.plain(keys.with_row_key(df, "key"))
    assert once == rows.plain(keys.with_row_key(df.repartition(3).orderBy("b"), "key"))
    assert sorted((r[:3] for r in once), key=repr) == sorted(made, key=repr)
    assert len({r[3] for r in once}) == len(made)
    # The keys of a row stay when other rows come and go.
    fewer = rows.plain(keys.with_row_key(df.where("n = 1"), "key"))
    assert set(fewer) <= set(once)
    assert keys.with_row_key(df.limit(0), "key").count() == 0
