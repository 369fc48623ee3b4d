import datetime as dt
import decimal

import rows
from ledgerloom.operators import mrr, reports
from ledgerloom.sources import schemas


def waterfall(spark, subs):
    return mrr.mrr_waterfall(rows.subscriptions(spark, subs), rows.calendar(spark))


def daily(spark, *days):
    data = [
        (dt.date.fromisoformat(d), gmv, gmv, revenue, 0, 0, revenue, decimal.Decimal("0.1"), None)
        for d, gmv, revenue in days
    ]
    return spark.createDataFrame(data, schemas.DAILY_FINANCIALS)


SUBS = [(1, "2023-01-01", "2023-03-31", 100), (2, "2023-02-01", "2023-02-28", 50), (2, "2023-04-05", None, 80)]


def test_monthly_totals_and_headlines(spark):
    months = reports.monthly_financials(
        daily(spark, ("2023-01-05", 100_000, 10_000), ("2023-01-20", 50_000, 0), ("2023-02-01", 300_000, 30_001))
    )
    got = {str(r.month): r for r in months.collect()}
    assert got["2023-01-01"].gmv_cents == 150_000 and got["2023-01-01"].gmv_k == 1.5
    assert got["2023-01-01"].take_rate_gross == 0.0667
    row = reports.gmv_kpis(months).first()
    assert (str(row.month), row.gmv_k, row.gmv_mom_pct, row.platform_revenue_mom_pct) == ("2023-02-01", 3.0, 100.0, 200.0)


def test_one_month_compares_with_itself(spark):
    row = reports.gmv_kpis(reports.monthly_financials(daily(spark, ("2023-01-05", 100, 10)))).first()
    assert (row.gmv_mom_pct, row.platform_revenue_mom_pct) == (0.0, 0.0)


def test_change_from_an_empty_month_divides_by_one(spark):
    months = reports.monthly_financials(daily(spark, ("2023-01-05", 0, 0), ("2023-02-05", 7, 0)))
    assert reports.gmv_kpis(months).first().gmv_mom_pct == 700.0


def test_movements_and_net_new(spark):
    movements = reports.monthly_mrr_waterfall(waterfall(spark, SUBS))
    got = {str(r.month)[:7]: r for r in movements.collect()}
    assert (got["2023-03"].churned_cents, got["2023-03"].mrr_end_cents) == (-50, 100)
    assert (got["2023-04"].churned_cents, got["2023-04"].mrr_end_cents) == (-100, 80)
    row = reports.mrr_kpis(movements).first()
    assert (str(row.month), row.mrr_mom_pct, row.net_new_mrr_k) == ("2023-04-01", -20.0, -0.001)


def test_retention_percent(spark):
    got = {str(r.month)[:7]: r for r in reports.net_revenue_retention(waterfall(spark, SUBS)).collect()}
    assert got["2023-01"].nrr_pct is None and got["2023-01"].active_brands == 1
    assert got["2023-02"].nrr_pct == 100.0
    assert got["2023-03"].nrr_pct == 66.67
    assert got["2023-04"].nrr_pct == 0.0 and got["2023-04"].active_brands == 1


def test_cohorts_keep_months_before_and_brands_that_return(spark):
    got = {
        (str(r.cohort_month)[:7], r.month_index): r.retention_pct
        for r in reports.cohort_retention(waterfall(spark, [*SUBS, (3, "2023-04-10", "2023-03-01", 5)])).collect()
    }
    assert got == {
        **{("2023-01", i): (100.0 if i < 3 else 0.0) for i in range(4)},
        ("2023-02", -1): 0.0,
        ("2023-02", 0): 100.0,
        ("2023-02", 1): 0.0,
        ("2023-02", 2): 100.0,
    }


def test_cohort_matrix_has_twelve_ages(spark):
    wide = reports.cohort_matrix(reports.cohort_retention(waterfall(spark, SUBS)))
    assert wide.columns == ["cohort", *(f"M+{i}" for i in range(12))]
    got = {r["cohort"]: list(r)[1:] for r in wide.collect()}
    assert got["2023-01"][:5] == [100.0, 100.0, 100.0, 0.0, None]


def test_cohort_age_ends_at_eleven(spark):
    got = reports.cohort_retention(waterfall(spark, [(1, "2022-08-01", "2024-05-31", 5)])).collect()
    assert sorted(r.month_index for r in got) == list(range(12))


def test_quarantine_reasons_by_frequency(spark):
    data = [("b",), ("a",), ("c",), ("c",)]
    got = reports.quarantine_breakdown(spark.createDataFrame(data, "reason STRING")).collect()
    assert [(r.reason, r["count"]) for r in got] == [("c", 2), ("a", 1), ("b", 1)]
