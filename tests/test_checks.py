import datetime as dt

import rows
from ledgerloom.operators import checks
from ledgerloom.params import Band
from ledgerloom.sources import schemas

TAKE = Band(0.05, 0.20)
GAP = Band(0.03, 0.07)


def payouts(spark, wrong, total):
    data = [(i, i, 1, 1, 5, 5, i < wrong, -int(i < wrong), "paid", rows.at("2023-01-01")) for i in range(total)]
    return spark.createDataFrame(data, schemas.STG_PAYOUTS)


def daily(spark, *rates):
    import decimal

    data = [
        (dt.date(2023, 1, i + 1), 1, 1, 1, 1, 1, 1, decimal.Decimal(r) if r else None, None)
        for i, r in enumerate(rates)
    ]
    return spark.createDataFrame(data, schemas.DAILY_FINANCIALS)


def test_payout_rate_band_is_closed_and_empty_is_zero(spark):
    def seen(wrong, total):
        row = checks.payout_discrepancy_rate(payouts(spark, wrong, total), GAP).first()
        return row.rate, row.status

    assert seen(3, 100) == (0.03, "pass")
    assert seen(7, 100) == (0.07, "pass")
    assert seen(2, 100) == (0.02, "fail")
    none = checks.payout_discrepancy_rate(payouts(spark, 0, 1).where("false"), GAP).first()
    assert (none.rate, none.total_rows, none.status) == (0.0, 0, "fail")


def test_take_rates_in_band_and_none_at_all(spark):
    assert checks.take_rate_range(daily(spark, "0.05", None, "0.2"), TAKE).first().status == "pass"
    assert checks.take_rate_range(daily(spark, "0.049999", "0.1"), TAKE).first().status == "fail"
    none = checks.take_rate_range(daily(spark, None), TAKE).first()
    assert (none.status, none.min_take_rate_gross, none.non_null_rows) == ("fail", None, 0)
    assert checks.take_rate_range(daily(spark, None).where("false"), TAKE).first().status == "fail"


def test_a_check_that_raises_is_a_failed_result_and_the_rest_runs(spark):
    def broken():
        raise RuntimeError("no such table")

    results = checks.run_checks(
        spark,
        {
            "V4": lambda: checks.payout_discrepancy_rate(payouts(spark, 5, 100), GAP),
            "V5": broken,
            "V6": lambda: spark.sql("SELECT raise_error('lost') AS x, 'pass' AS status"),
            "V7": lambda: checks.take_rate_range(daily(spark, "0.1"), TAKE),
        },
    )
    got = {r.name: (r.status, r.detail) for r in results.collect()}
    assert {n: s for n, (s, _) in got.items()} == {"V4": "pass", "V5": "fail", "V6": "fail", "V7": "pass"}
    assert got["V5"][1]["error"] == "no such table" and "lost" in got["V6"][1]["error"]
    assert got["V4"][1]["mismatch_rows"] == "5" and got["V4"][1]["rate"] == "0.05"


def test_reports_are_appended_and_the_latest_is_read(spark, tmp_path):
    folder = str(tmp_path / "reports")
    schema = checks.RESULT_SCHEMA
    first = spark.createDataFrame([("V2", "fail", {"a": "1"}), ("V1", "pass", {"b": None})], schema)
    second = spark.createDataFrame([("V1", "pass", {"b": "2"})], schema)
    checks.write_report(first, folder, dt.datetime(2024, 1, 2))
    checks.write_report(second, folder, dt.datetime(2024, 1, 1))
    got = checks.latest_report(spark, folder).collect()
    assert [(r.name, r.status) for r in got] == [("V1", "pass"), ("V2", "fail")]
    assert tuple(got[0].summary) == (2, 1, 1)
    assert got[0].generated_at == dt.datetime(2024, 1, 2)
