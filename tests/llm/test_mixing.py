import collections
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from helpers import documents
from ledgerloom.llm import catalog, mixing


def shared_out(sizes):
    """Targets by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, full, left = dict.fromkeys(names, 0.0), set(), float(sum(sizes.values()))
    while left > 1e-9:
        weights = sum(weight[s] for s in names if s not in full)
        for s in names:
            if s not in full:
                target[s] += left * weight[s] / weights
        left = 0.0
        for s in names:
            if s not in full and target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                full.add(s)
    return target


def rows_of(rng):
    sources = {"a": 3, "b": 120, "é": 30, "src10": 1, "src2": 60, None: 20, "empty": 4, "": 8}
    rows, n = [], 0
    for source, count in sources.items():
        for _ in range(count):
            rows.append((n, " ".join(["word"] * (0 if source == "empty" else rng.randint(1, 50))), None, source))
            n += 1
    return rows + [(n, None, None, "a"), (n + 1, " \t", None, "b"), (3, rows[3][1], None, "b"), (None, "no id here", None, "b"), (n + 2, "x\u00a0y z\x0bw", None, "b")]


def test_targets_and_takes(spark):
    rows = rows_of(random.Random(2))
    docs = documents(spark, rows, "size weight target part whole bucket order_key words_before")
    found = mixing.mixture(docs).collect()
    assert len(found) == len(rows)
    sizes, taken = collections.Counter(), collections.Counter()
    for i, text, _, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    target = shared_out(sizes)
    for r in found:
        taken[r["source"]] += r["taken"]
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]], abs=1e-6)
        assert r["taken"] <= 3 * r["size"]
    for source in sizes:
        assert abs(taken[source] - target[source]) <= 1
    positions = [r["position"] for r in found if r["position"] is not None]
    assert positions == sorted(positions) and 0 <= positions[0] and positions[-1] <= 1
    again = mixing.mixture(docs.repartition(7)).collect()
    assert collections.Counter(map(tuple, found)) == collections.Counter(map(tuple, again))


CLASHING = (
    "row_ place size start of_source of_bucket before_here take source_size weight target words_before whole rest part bucket words pass_no position"
)


def test_mixed_documents_are_whole_and_come_near_the_target(spark):
    rows = rows_of(random.Random(3))
    docs = documents(spark, rows, CLASHING)
    sizes = collections.Counter()
    words = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    for _, text, _, source in rows:
        sizes[source] += words(text)
    target = shared_out(sizes)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.dtypes == docs.dtypes
    found = mixed.collect()
    given = {(i, text, source) for i, text, _, source in rows}
    assert {(r["doc_id"], r["text"], r["source"]) for r in found} <= given
    taken, largest = collections.Counter(), collections.Counter()
    for r in found:
        taken[r["source"]] += words(r["text"])
    for _, text, _, source in rows:
        largest[source] = max(largest[source], words(text))
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in sizes)
    assert collections.Counter(map(tuple, found)) == collections.Counter(map(tuple, mixing.mixed_documents(docs.repartition(5)).collect()))


def test_rows_of_one_id_are_spread_and_settled_by_their_texts(spark):
    rows = [(None, f"text number {n} " + "word " * (n % 7), None, "b") for n in range(200)] + [(1, f"other {n}", None, "b") for n in range(100)]
    docs = documents(spark, rows)
    buckets = docs.select(F.substring(mixing.place_of(F.col("doc_id"), F.col("text")), 1, mixing.BUCKET_DIGITS)).distinct().count()
    assert buckets > 200
    once = collections.Counter(map(tuple, mixing.mixed_documents(docs).collect()))
    assert once == collections.Counter(map(tuple, mixing.mixed_documents(docs.orderBy("text").repartition(3)).collect()))


def test_times_invert_the_demand_of_each_schedule(spark):
    table = spark.range(0, 101).selectExpr("id * 10 as words", "1000.0D as target")
    for weight, tilt in zip(mixing.WEIGHTS, mixing.TILTS):
        times = [
            r[0] for r in table.select(mixing.training_time(F.col("words"), F.col("target"), F.lit(weight))).collect()
        ]
        for n, t in enumerate(times):
            # The weight goes from 1 - tilt to 1 + tilt; its integral up to t is the share of the words asked for.
            steps = 2000
            asked = sum(1 - tilt + 2 * tilt * (i + 0.5) * t / steps for i in range(steps)) * t / steps
            assert asked == pytest.approx(n / 100, abs=1e-6)


def test_no_rows_and_no_words(spark):
    assert mixing.mixture(documents(spark, [])).count() == 0 and mixing.mixed_documents(documents(spark, [])).count() == 0
    assert [r["taken"] for r in mixing.mixture(documents(spark, [(1, None), (2, "")])).collect()] == [0, 0]


def test_equals_sql(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = ["doc_id", "size", "source_size", "target", "taken", "source", "position"]
    ours = collections.Counter(tuple(r[n] for n in names) for r in mixing.mixture(docs).collect())
    assert ours == collections.Counter(con.execute(f"SELECT {', '.join(names)} FROM ({catalog.MIXING})").fetchall())
