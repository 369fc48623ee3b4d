import hashlib
import random
import re

from pyspark.sql import functions as F

from helpers import by_id, documents, prose
from ledgerloom.llm import multiset


def prints(spark, texts):
    table = multiset.with_fingerprint(spark.createDataFrame(list(enumerate(texts)), "n long, text string"), "text", "fp")
    return [r["fp"] for r in table.orderBy("n").collect()]


def test_order_insertion_and_deletion(spark):
    a, b, c = "one two three four five", "six seven", "eight nine ten"
    found = prints(spark, [f"{a}\n{b}\n{c}", f"{c}\n\n{a}\n{b}", f"{a}\n{c}", b, f"{a}\n{b}\n{c}\n{c}", None, "", f"{b} {a}\n{c}"])
    assert found[0] == found[1] != found[4] and found[5] == found[6] == [0] * len(found[0])
    assert found[7] != found[0]
    table = spark.createDataFrame([(found[2], found[3], found[0])], "x array<bigint>, y array<bigint>, z array<bigint>")
    r = table.select(multiset.add(F.col("x"), F.col("y")).alias("sum"), multiset.take_away(F.col("z"), F.col("y")).alias("rest")).first()
    assert r["sum"] == found[0] and r["rest"] == found[2]


def test_lanes_wrap_around(spark):
    full = [multiset.MASK] * 3
    table = spark.createDataFrame([(full, [multiset.ONES] * 3)], "x array<bigint>, y array<bigint>")
    assert table.select(multiset.add(F.col("x"), F.col("y")).alias("s")).first()["s"] == [0, 0, 0]
    assert table.select(multiset.take_away(F.lit([0, 0, 0]).cast("array<bigint>"), F.col("y")).alias("s")).first()["s"] == full


def plain_edits(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    out = {}
    for n, (i, text) in enumerate(order):
        text, following = text or "", order[(n + 1) % len(order)][1] or ""
        k = len(text) // 4
        out[i] = text[: len(text) - k] + following[:k]
    return out


def test_edited_texts_and_likeness(spark, folder):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows += [(5000, None), (5001, ""), (5002, "🙂é\n" * 30), (5003, " \n "), (None, "the last one, without id"), (5004, rows[0][1]), (5005, rows[0][1])]
    docs = documents(spark, rows, "own lines runs blocks sums row_key next_key copies place times at range_no order_no is_guest next_text lanes_a")
    found = by_id(multiset.edited_fingerprints(docs))
    edits = plain_edits(rows)
    assert len(found) == len(rows)
    for i, text in rows:
        r = found[i]
        assert r["n_chars"] == len(text or "")
        assert r["edited_sha256"] == hashlib.sha256(edits[i].encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert found[5004]["fingerprint"] == found[5005]["fingerprint"] == found[rows[0][0]]["fingerprint"]
    assert found[5004]["near_next"] == 1.0
    real = [found[i] for i, t in rows[:150]]
    assert sum(r["near_edited"] > r["near_next"] for r in real) / len(real) > 0.9
    assert sum(r["near_edited"] for r in real) / len(real) > 0.6


def test_repeated_ids_one_row_and_none(spark):
    assert multiset.edited_fingerprints(documents(spark, [])).count() == 0
    alone = multiset.edited_fingerprints(documents(spark, [(1, "abcdefgh")])).collect()
    assert alone[0]["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest()
    same = multiset.edited_fingerprints(documents(spark, [(1, "abcd"), (1, "abcd"), (1, "abcd")])).collect()
    assert len(same) == 3 and {r["near_next"] for r in same} == {1.0}


def test_likeness_of_copies_with_a_word_put_in_front(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    texts = [prose(rng, words, 300) for _ in range(10)]
    rows = [(2 * n + k, f"new {t}" if k else t) for n, t in enumerate(texts) for k in (0, 1)]
    found = by_id(multiset.edited_fingerprints(documents(spark, rows)))
    assert min(found[2 * n]["near_next"] for n in range(10)) > 0.9
    assert sum(found[2 * n + 1]["near_next"] for n in range(10)) / 10 < 0.3


def test_runs_stay_within_their_line_and_leave_out_blanks_at_its_end(spark):
    table = spark.createDataFrame([("a b c d e \t\n\nf  g\r\nh",)], "text string")
    runs = table.select(F.regexp_extract_all("text", F.lit(multiset.RUN_PATTERN), F.lit(1))).first()[0]
    assert runs == ["a b c d", "b c d e", "c d e", "d e", "e", "f  g", "g", "h"]
    long = spark.createDataFrame([("x" * 3_000_000 + " y",)], "text string")
    assert long.select(F.size(F.regexp_extract_all("text", F.lit(multiset.RUN_PATTERN), F.lit(1)))).first()[0] == 2


def test_copies_of_a_row_are_written_out_in_parts(spark, monkeypatch):
    monkeypatch.setattr(multiset, "COPIES_AT_A_TIME", 4)
    rows = [(1, "abcdefgh ij")] * 13 + [(None, None)] * 9 + [(None, "no id, no copy")] + [(2, "the end of it")] * 4
    found = [(r["doc_id"], r["edited_sha256"], r["near_next"]) for r in multiset.edited_fingerprints(documents(spark, rows)).collect()]
    assert [sum(r[0] == i for r in found) for i in (1, 2, None)] == [13, 4, 10]
    ends = [hashlib.sha256(b"abcdefgh " + end).hexdigest() for end in (b"ab", b"th")]
    assert [sum(r[1] == end for r in found) for end in ends] == [12, 1]


def plain_fingerprint(spark, text):
    """Lanes counted one by one; only the hashes are Spark's."""
    lines = [line for line in (text or "").split("\n") if line.strip(" ")]
    words = [re.findall(r"\S+", line) for line in lines]
    runs = [" ".join(w[n : n + 4]) for w in words for n in range(len(w))]
    table = spark.createDataFrame([(runs, lines)], "runs array<string>, lines array<string>")
    hashed = lambda seed: F.transform("lines", lambda line: F.xxhash64(F.lit(seed), line))
    seeds = [hashed(n).alias(f"e{n}") for n in range(8)]
    r = table.select(F.transform("runs", lambda x: F.xxhash64(x)).alias("hashes"), *seeds).first()
    exact = []
    for n in range(8):
        lanes = [sum((h >> s) & 0xFFFFF for h in r[f"e{n}"]) % (1 << 20) for s in (0, 21, 42)]
        exact.append(sum(v << s for v, s in zip(lanes, (0, 21, 42))))
    return exact + [sum((h >> bit) & 1 for h in r["hashes"]) for bit in range(64)] + [len(runs)]


def test_lanes_equal_those_counted_one_by_one(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(90)]
    texts = [None, "", "a", "\n".join(prose(rng, words, n) for n in (1, 126, 127, 128, 700)), prose(rng, words, 254), prose(rng, words, 127)]
    assert prints(spark, texts) == [plain_fingerprint(spark, t) for t in texts]


def test_likeness_of_very_long_repetitive_texts(spark):
    rows = [(1, "a b c\n" * 400_000), (2, "a b c\n" * 600_000), (3, "d e f g\n" * 10)]
    found = by_id(multiset.edited_fingerprints(documents(spark, rows)))
    assert found[1]["near_next"] > 0.99 and found[1]["near_edited"] > 0.99 and found[2]["near_next"] < 0.9


def test_counts_below_zero_keep_their_sign(spark):
    a, b = prints(spark, ["one two three", "four five six seven\neight nine"])
    table = spark.createDataFrame([(a, b)], "x array<bigint>, y array<bigint>")
    table = table.withColumn("back", multiset.add(multiset.take_away(F.col("x"), F.col("y")), F.col("y")))
    table = multiset.with_likeness(table.withColumn("less", multiset.take_away(F.lit([0] * len(a)).cast("array<bigint>"), F.col("x"))), "less", "x", "near")
    assert table.select("back", "near").first() == (a, 0.0)
