import zlib

from helpers import by_id, documents
from ledgerloom.llm import quality


def test_held_out_accuracy_and_every_row(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found, truth = by_id(quality.score(docs, labels)), by_id(labels)
    assert len(found) == docs.count()
    tested = [i for i in truth if found[i]["held_out"]]
    assert sum(found[i]["predicted"] == truth[i]["quality"] for i in tested) / len(tested) > 0.95
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in found.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in found.items())


def test_odd_rows(spark):
    good = [(i, f"This is line {i} of fair text.\nIt goes on for a while, as text does.") for i in range(30)]
    bad = [(100 + i, f"BUY!! NOW!! {i}\n### $$$ ###") for i in range(30)]
    odd = [(200, None), (201, ""), (None, good[0][1]), (202, "x" * 100_000), (203, "\n" * 5000), (1, good[1][1])]
    docs = documents(spark, good + bad + odd, "score predicted quality quality_score")
    labels = spark.createDataFrame(
        [(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(None, 1, 0), (5, 0, 0), (6, None, 0), (7, 9, 0)], "doc_id long, quality int, toxic int"
    )
    rows = quality.score(docs, labels).collect()
    assert len(rows) == len(good) + len(bad) + len(odd)
    found = {r["doc_id"]: r for r in rows}
    assert all(found[i]["predicted"] == 1 for i, _ in good) and all(found[i]["predicted"] == 0 for i, _ in bad)
    assert found[200]["score"] == found[201]["score"]
    kept = quality.keep_good(docs, labels)
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == docs.columns and ids.count(1) == 2 and 100 not in ids


def test_nothing_to_learn_from(spark):
    docs = documents(spark, [(1, "a"), (2, None)])
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in quality.score(docs, labels).collect()} == {0.5}
    assert quality.keep_good(docs, labels).count() == 2
    assert quality.score(documents(spark, []), labels).count() == 0


def test_long_labelled_texts_are_learned_from(spark):
    long = "\n".join(f"This is line {n} of fair text." for n in range(20_000))
    short = [(i, f"Fair text {i}, in a line or two.\nIt goes on.") for i in range(3)]
    docs = documents(spark, [(1, long), (2, short[0][1]), (3, None)])
    found = by_id(docs.select("doc_id", quality.stretches_of(docs.text).alias("s")))
    assert found[2]["s"] == short[0][1] and found[3]["s"] is None
    parts = found[1]["s"]
    assert len(parts) == quality.STRETCHES * (quality.STRETCH + 1) - 1
    at = [long.index(parts[n * (quality.STRETCH + 1) :][: quality.STRETCH]) for n in range(quality.STRETCHES)]
    assert [4 * a // len(long) for a in at] == [0, 1, 2, 3]
    # All good documents are long, and the model still learns from them.
    rows = [(i, f"{i}\n{long}"[: 120_000 + i]) for i in range(12)] + [(100 + i, f"BUY!! NOW!! {i}\n### $$$ ###") for i in range(12)]
    labels = spark.createDataFrame([(i, int(i < 100), 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    scores = by_id(quality.score(documents(spark, rows), labels))
    assert all(r["predicted"] == (i < 100) for i, r in scores.items())


def test_one_id_with_several_texts_teaches_the_same_in_every_run(spark):
    rows = [(i % 20, f"Line {i} of fair text." if i % 20 < 10 else f"### {i} $$$") for i in range(60)]
    labels = spark.createDataFrame([(i, int(i < 10), 0) for i in range(20)], "doc_id long, quality int, toxic int")
    docs = documents(spark, rows)
    first, second = quality.fit(docs, labels), quality.fit(docs.orderBy("text").repartition(5), labels)
    assert (first.weights == second.weights).all() and first.slope == second.slope
