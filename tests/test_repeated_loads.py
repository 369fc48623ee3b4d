"""Stored tables that are loaded again: only absent keys are added, only changed parts rebuilt."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

import rows
from ledgerloom.operators import financials, mrr
from ledgerloom.plans import refresh
from ledgerloom.sources import keyed
from ledgerloom.sources.keyed import KeyedTable


def pairs(spark, values):
    return spark.createDataFrame(values, "k long, v string")


def stored(table):
    return rows.plain(table.read())


def files_of(root):
    return {os.path.join(at, n): os.stat(os.path.join(at, n)).st_mtime_ns for at, _, names in os.walk(root) for n in names if n.endswith(".parquet")}


def test_a_batch_loaded_twice_changes_nothing(spark, tmp_path):
    batch = pairs(spark, [(n, f"v{n}") for n in range(300)])
    table = KeyedTable(spark, str(tmp_path), ["k"], batch.schema, buckets=4)
    assert stored(table) == [] and table.candidate_files(batch) == []
    assert table.insert_absent(batch) == 300
    before = stored(table)
    assert table.insert_absent(batch) == 0
    assert stored(table) == before == sorted(((n, f"v{n}", 1) for n in range(300)), key=repr)
    assert table.loads().count() == 1


def test_the_first_row_of_a_key_counts_and_rows_without_a_key_never_conflict(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), ["k"], pairs(spark, []).schema, buckets=2)
    assert table.insert_absent(pairs(spark, [(1, "b"), (1, "a"), (2, "c"), (None, "x")]), ["v"]) == 3
    assert table.insert_absent(pairs(spark, [(2, "z"), (3, "d"), (None, "x"), (None, "x")]), ["v"]) == 3
    assert stored(table) == sorted(
        [(1, "a", 1), (2, "c", 1), (None, "x", 1), (3, "d", 2), (None, "x", 2), (None, "x", 2)], key=repr
    )


def test_random_loads_equal_a_dictionary(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "MOST_ROWS", 40)
    rng = random.Random(1)
    table, known = KeyedTable(spark, str(tmp_path), ["k", "v"], pairs(spark, []).schema, buckets=3), {}
    for load in range(1, 5):
        batch = [(rng.randrange(150), rng.choice("ab")) for _ in range(200)]
        fresh = {key for key in batch if key not in known}
        assert table.insert_absent(pairs(spark, batch)) == len(fresh)
        known |= dict.fromkeys(fresh, load)
    assert stored(table) == sorted(((k, v, n) for (k, v), n in known.items()), key=repr)


def test_only_files_that_may_hold_a_key_are_read(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), ["k"], pairs(spark, []).schema, buckets=8)
    for load in range(3):
        table.insert_absent(pairs(spark, [(load * 10_000 + 2 * n, "v") for n in range(4000)]))
    assert len([f for f in table.read().inputFiles() if "/data/" in f]) == 24
    assert len(table.candidate_files(pairs(spark, [(10_000, "v")]))) == 1
    assert table.candidate_files(pairs(spark, [(90_000, "v")])) == []
    # Inside the range of keys, but none of them: the filters leave few of 300 single look-ups a file.
    odd = [(10_001 + 2 * n, "v") for n in range(300)]
    met = sum(len(table.candidate_files(pairs(spark, odd[n : n + 1]))) for n in range(0, 300, 30))
    assert met <= 2
    batch = pairs(spark, [(10_000, "v"), (99_999, "w")])
    absent = table.absent(batch)
    assert len([f for f in absent.inputFiles() if "/data/" in f]) <= 2
    assert [tuple(r) for r in absent.collect()] == [(99_999, "w")]


def test_a_load_that_breaks_off_is_not_seen(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path), ["k"], pairs(spark, []).schema, buckets=2)
    table.insert_absent(pairs(spark, [(1, "a")]))
    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_write_index", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            table.insert_absent(pairs(spark, [(2, "b")]))
    assert stored(table) == [(1, "a", 1)]
    assert table.insert_absent(pairs(spark, [(2, "b")])) == 1
    assert stored(table) == [(1, "a", 1), (2, "b", 2)]


ENTRIES = "payment_id long, entry_type string, amount_cents long, entry_date date"


def entries(spark, changes=()):
    made = {n: (n, "brand_charge", 1000 + n, dt.date(2023, 1 + n % 3, 1 + n % 5)) for n in range(60)}
    made.update(changes)
    return spark.createDataFrame([r for r in made.values() if r], ENTRIES)


def test_one_changed_payment_rebuilds_one_day(spark, tmp_path):
    first = entries(spark)
    table = refresh.daily_table(spark, str(tmp_path), financials.daily_financials(first).schema)
    assert {r["change"] for r in refresh.refresh_daily(table, first).collect()} == {"new"}
    assert rows.plain(table.read()) == rows.plain(financials.daily_financials(first))
    before = files_of(f"{tmp_path}/table")
    assert refresh.refresh_daily(table, first.orderBy(F.desc("payment_id"))).count() == 0
    assert files_of(f"{tmp_path}/table") == before

    second = entries(spark, {7: (7, "brand_charge", 5, dt.date(2023, 2, 3))})
    touched = refresh.refresh_daily(table, second).collect()
    assert [tuple(r) for r in touched] == [(dt.date(2023, 2, 3), "changed")]
    assert rows.plain(table.read()) == rows.plain(financials.daily_financials(second))
    after = files_of(f"{tmp_path}/table")
    assert {f for f in before if before[f] != after.get(f)} == {f for f in before if "folder=2023-02" in f}


def test_days_come_and_go(spark, tmp_path):
    gone = {n: None for n in range(60) if n % 3 == 1}  # all of February
    table = refresh.daily_table(spark, str(tmp_path), financials.daily_financials(entries(spark)).schema)
    refresh.refresh_daily(table, entries(spark))
    fewer = entries(spark, {**gone, 3: None, 100: (100, "brand_charge", 1, dt.date(2023, 9, 9)), 101: (101, "brand_charge", 1, None)})
    changes = {r["entry_date"]: r["change"] for r in refresh.refresh_daily(table, fewer).collect()}
    assert changes[dt.date(2023, 2, 1)] == "gone" and changes[dt.date(2023, 9, 9)] == "new" and changes[None] == "new"
    assert rows.plain(table.read()) == rows.plain(financials.daily_financials(fewer))
    refresh.refresh_daily(table, entries(spark))
    assert rows.plain(table.read()) == rows.plain(financials.daily_financials(entries(spark)))


def test_equal_sums_of_other_rows_are_a_change(spark):
    a = spark.createDataFrame([(1, None, 2), (1, 3, None)], "p int, x int, y int")
    b = spark.createDataFrame([(1, None, 3), (1, 2, None)], "p int, x int, y int")
    c = spark.createDataFrame([(1, 2, None), (1, None, 3)], "p int, x int, y int")
    first, second, third = (rows.plain(refresh.part_digests(x, "p")) for x in (a, b, c))
    assert first != second and second == third


def test_a_refresh_that_breaks_off_is_made_up(spark, tmp_path, monkeypatch):
    table = refresh.daily_table(spark, str(tmp_path), financials.daily_financials(entries(spark)).schema)
    refresh.refresh_daily(table, entries(spark))
    later = entries(spark, {8: None})
    with pytest.raises(ZeroDivisionError):
        table.refresh(later, lambda rows_: 1 / 0)
    assert rows.plain(table.read()) == rows.plain(financials.daily_financials(entries(spark)))
    assert refresh.refresh_daily(table, later).count() == 1
    assert rows.plain(table.read()) == rows.plain(financials.daily_financials(later))


def test_waterfall_of_one_brand_is_rebuilt_and_all_if_the_months_change(spark, tmp_path):
    spans = [(b, "2023-01-10", "2023-04-01", 100 * b) for b in range(1, 8)]
    first, calendar = rows.subscriptions(spark, spans), rows.calendar(spark)
    table = refresh.waterfall_table(spark, str(tmp_path), mrr.mrr_waterfall(first, calendar).schema)
    refresh.refresh_waterfall(table, first, calendar)
    full = lambda s: rows.plain(mrr.mrr_waterfall(s, calendar))
    assert rows.plain(table.read().drop("brand_group")) == full(first)
    second = rows.subscriptions(spark, [*spans[:3], (4, "2023-02-10", "2023-03-01", 7), *spans[4:]])
    assert [r["brand_group"] for r in refresh.refresh_waterfall(table, second, calendar).collect()] == [4]
    assert rows.plain(table.read().drop("brand_group")) == full(second)
    third = rows.subscriptions(spark, [*spans, (3, "2023-02-10", "2023-09-01", 7)])
    assert refresh.refresh_waterfall(table, third, calendar).count() == 7
    assert rows.plain(table.read().drop("brand_group")) == full(third)
