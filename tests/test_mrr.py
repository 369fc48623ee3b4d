import random

import pytest
from pyspark.sql import functions as F

import rows
from ledgerloom.operators import guards, mrr


def waterfall(spark, subs):
    return mrr.mrr_waterfall(rows.subscriptions(spark, subs), rows.calendar(spark))


def by_month(df):
    return {
        (r.brand_id, str(r.month_start_date)[:7]): tuple(r[c] for c in df.columns[2:])
        for r in df.collect()
    }


def test_monthly_subscription_starts_stays_and_churns(spark):
    got = by_month(waterfall(spark, [(101, "2023-01-01", "2023-03-31", 50_000)]))
    assert got == {
        (101, "2023-01"): (0, 50_000, 0, 0, 0, 50_000),
        (101, "2023-02"): (50_000, 0, 0, 0, 0, 50_000),
        (101, "2023-03"): (50_000, 0, 0, 0, 0, 50_000),
        (101, "2023-04"): (50_000, 0, 0, 0, 50_000, 0),
    }


def test_annual_subscription_counts_its_monthly_share(spark):
    df = waterfall(spark, [(102, "2023-01-01", "2023-03-31", 10_000)])
    got = by_month(df)
    assert [got[102, m][-1] for m in ("2023-01", "2023-02", "2023-03", "2023-04")] == [10_000, 10_000, 10_000, 0]
    assert got[102, "2023-04"][4] == 10_000
    assert mrr.continuity_breaks(df).count() == 0


def test_expansion_contraction_and_reactivation(spark):
    got = by_month(
        waterfall(
            spark,
            [
                (1, "2023-01-10", "2023-06-05", 100),
                (1, "2023-02-01", "2023-03-31", 50),
                (1, "2023-09-01", "2023-10-15", 70),
            ],
        )
    )
    assert got[1, "2023-01"] == (0, 100, 0, 0, 0, 100)
    assert got[1, "2023-02"] == (100, 0, 50, 0, 0, 150)
    assert got[1, "2023-04"] == (150, 0, 0, 50, 0, 100)
    assert got[1, "2023-07"] == (100, 0, 0, 0, 100, 0)
    # A return from 0 is neither new nor an expansion.
    assert got[1, "2023-09"] == (0, 0, 0, 0, 0, 70)
    assert got[1, "2023-11"] == (70, 0, 0, 0, 70, 0)


def test_late_brand_has_prior_zero_not_null(spark):
    got = by_month(waterfall(spark, [(1, "2023-01-01", "2023-04-30", 10), (2, "2023-03-05", None, 30)]))
    assert got[2, "2023-01"] == (0, 0, 0, 0, 0, 0)
    assert got[2, "2023-03"] == (0, 0, 0, 0, 0, 30)
    assert max(m for _, m in got) == "2023-05"


def test_spine_ends_after_the_latest_end_and_cuts_later_starts(spark):
    got = by_month(waterfall(spark, [(1, "2023-01-01", "2023-02-28", 10), (2, "2023-08-01", None, 99)]))
    assert sorted({m for _, m in got}) == ["2023-01", "2023-02", "2023-03"]
    assert all(v[-1] == 0 for (brand, _), v in got.items() if brand == 2)


def test_open_ended_only_uses_latest_start(spark):
    got = by_month(waterfall(spark, [(1, "2023-01-01", None, 10), (1, "2023-03-15", None, 5)]))
    assert [got[1, m][-1] for m in ("2023-01", "2023-02", "2023-03", "2023-04")] == [10, 10, 15, 15]


def test_end_before_start_counts_in_the_shared_month_only(spark):
    got = by_month(
        waterfall(
            spark,
            [(1, "2023-01-01", "2023-03-31", 10), (2, "2023-02-14", "2023-02-01", 7), (3, "2023-03-10", "2023-02-01", 9)],
        )
    )
    assert [got[2, m][-1] for m in ("2023-01", "2023-02", "2023-03")] == [0, 7, 0]
    assert {v[-1] for (brand, _), v in got.items() if brand == 3} == {0}


def test_calendar_clips_the_spine(spark):
    got = by_month(waterfall(spark, [(1, "2021-11-20", "2022-08-15", 10), (2, "2024-06-01", "2026-01-31", 20)]))
    months = sorted({m for _, m in got})
    assert (months[0], months[-1], len(months)) == ("2022-07", "2024-07", 25)
    assert got[1, "2022-07"] == (0, 10, 0, 0, 0, 10)


def test_no_subscriptions_give_no_rows(spark):
    empty = rows.subscriptions(spark, [(1, "2023-01-01", None, 1)]).where("false")
    calendar = rows.calendar(spark)
    assert mrr.brand_month_spine(empty, calendar).isEmpty()
    assert mrr.mrr_waterfall(empty, calendar).isEmpty()


def test_span_without_start_counts_nowhere(spark):
    subs = rows.subscriptions(spark, [(1, "2023-01-01", "2023-03-31", 10), (2, "2023-01-01", None, 7)])
    lost = subs.withColumn("start_date", F.when(F.col("brand_id") == 1, F.col("start_date")))
    got = by_month(mrr.mrr_waterfall(lost, rows.calendar(spark)))
    assert {v[-1] for (brand, _), v in got.items() if brand == 2} == {0}


def test_continuity_break_is_found_and_stops(spark):
    df = waterfall(spark, [(1, "2023-01-01", "2023-03-31", 50)])
    broken = df.withColumn(
        "mrr_start_cents", F.when(F.month("month_start_date") == 3, F.lit(1)).otherwise(F.col("mrr_start_cents"))
    )
    assert mrr.continuity_breaks(broken).count() == 1
    with pytest.raises(guards.ContinuityError):
        guards.require(guards.broken_months(broken), "months", guards.ContinuityError)


def test_levels_match_brute_force(spark):
    """Against every subscription tried on every month of every brand."""
    rng = random.Random(7)
    subs = []
    for _ in range(400):
        brand = 1 if rng.random() < 0.4 else rng.randint(2, 25)  # one brand holds many
        start = rng.randint(0, 500)
        end = None if rng.random() < 0.3 else start + rng.randint(-40, 200)
        shown = [str(rows.dt.date(2022, 9, 1) + rows.dt.timedelta(days=d)) if d is not None else None for d in (start, end)]
        subs.append((brand, *shown, rng.randint(1, 900)))
    table, calendar = rows.subscriptions(spark, subs), rows.calendar(spark)
    got = {(r.brand_id, str(r.month_start_date)): r.mrr_cents for r in mrr.brand_month_mrr(table, calendar).collect()}
    spine = {(r.brand_id, str(r.month_start_date)) for r in mrr.brand_month_spine(table, calendar).collect()}
    assert set(got) == spine

    def active(s, month):
        first = rows.day(month)
        last = (first.replace(day=28) + rows.dt.timedelta(days=4)).replace(day=1) - rows.dt.timedelta(days=1)
        return rows.day(s[1]) <= last and (s[2] is None or rows.day(s[2]) >= first)

    assert got == {(b, m): sum(s[3] for s in subs if s[0] == b and active(s, m)) for b, m in spine}
