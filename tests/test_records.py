"""CSV records with line breaks, against Spark's reader that gives a file to one task."""

import random
from collections import Counter

import pytest

from ledgerloom.sources import records
from ledgerloom.sources.files import load_raw, write_raw

SCHEMA = "id BIGINT, a STRING, b STRING"
PARTS = ["x", "\n", '"', ",", " ", "", "\n\n", "é", '""', "plain words", "\r\n"]


def random_rows(n, seed):
    draw = random.Random(seed)
    text = lambda: draw.choice([None, "".join(draw.choices(PARTS, k=draw.randint(0, 6)))])
    return [(i, text(), text()) for i in range(n)]


def by_one_task(spark, path):
    df = spark.read.schema(SCHEMA).options(nullValue="", emptyValue="<empty>", escape='"', multiLine=True, lineSep="\n", mode="FAILFAST")
    df = df.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return Counter((r[0], *("" if t == "<empty>" else t for t in r[1:])) for r in df.csv(path).collect())


@pytest.mark.parametrize("chunk_bits", [0, 2, 16])
def test_random_texts_come_back_from_small_splits(spark, tmp_path, monkeypatch, chunk_bits):
    monkeypatch.setattr(records, "CHUNK_BITS", chunk_bits)
    rows = random_rows(400, chunk_bits)
    path = str(tmp_path / "csv")
    write_raw(spark.createDataFrame(rows, SCHEMA).coalesce(2), path, multi_line=True)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        found = load_raw(spark, path, SCHEMA, multi_line=True)
        assert records._lines(spark, path).rdd.getNumPartitions() > 4
        assert Counter(map(tuple, found.collect())) == Counter(rows) == by_one_task(spark, path)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_record_over_many_splits(spark, tmp_path):
    long = "line\n" * 5_000
    (tmp_path / "a.csv").write_text(f'1,"{long}",z\n2,"{long}""\n",\n\n3,,""\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        found = sorted(load_raw(spark, str(tmp_path), SCHEMA, multi_line=True).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [tuple(r) for r in found] == [(1, long, "z"), (2, long + '"\n', None), (3, None, "")]


def test_carriage_returns_and_no_last_line_break(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'1,a,b\r\n2,"c\r\nd",e\r\n3,f,g')
    found = sorted(load_raw(spark, str(tmp_path), SCHEMA, multi_line=True).collect())
    assert [tuple(r) for r in found] == [(1, "a", "b"), (2, "c\r\nd", "e"), (3, "f", "g")]


def test_only_wanted_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1,"a\nb",c\n')
    assert load_raw(spark, str(tmp_path), SCHEMA, ["b"], multi_line=True).collect() == [("c",)]


def test_an_open_quote_stops_the_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1,"a\nb,c\n')
    with pytest.raises(Exception, match="ends inside quotes"):
        load_raw(spark, str(tmp_path), SCHEMA, multi_line=True).collect()


def test_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert load_raw(spark, str(tmp_path), SCHEMA, multi_line=True).count() == 0
