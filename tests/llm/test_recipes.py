import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import documents, prose
from ledgerloom.llm import recipes

WORDS = "open corn sand do land noon cat window candy no bacon modern inside canopy sandy on".split()


def weak(chunk):
    """Few values, so that different chunks often have one hash."""
    return F.pmod(F.xxhash64(chunk), F.lit(5))


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        firsts = [ids.index(keep)]
        out += [(i, keep, len(ids), n in firsts, sha) for n, i in enumerate(ids)]
    return sorted(out, key=str)


def found(spark, rows, **options):
    result = recipes.exact_duplicates(documents(spark, rows, "row_no chunk hash recipe group_size kept last at variants"), **options)
    return sorted((tuple(r) for r in result.collect()), key=str)


@pytest.mark.parametrize("hash_of", [F.xxhash64, weak])
def test_groups_equal_those_of_the_texts(spark, hash_of):
    rng = random.Random(3)
    texts = [prose(rng, WORDS, rng.choice([1, 3, 40, 400])) for _ in range(40)]
    texts += ["", " ", "\n", "漢字。" * 300, "x" * 9000, "x" * 9001, "é" * 50, "é" * 50, "a\U0001f600" * 3000]
    texts += [t[:-1] + "!" for t in texts[:20] if t] + [t[1:] for t in texts[:5]]
    rows = [(n, rng.choice(texts)) for n in range(200)] + [(300, None), (301, None)]
    assert found(spark, rows, hash_of=hash_of) == brute(rows)


def test_chunks_together_are_the_text_and_their_cuts_follow_its_characters(spark):
    rng = random.Random(5)
    long = prose(rng, WORDS, 20_000)
    texts = [long, "some words put in front, " + long, "", "x" * 10_000, "漢字、" * 5000, "\n" * 5000]
    rows = documents(spark, list(enumerate(texts))).select("doc_id", recipes.chunks_of(F.col("text")).alias("c")).collect()
    cut = {r["doc_id"]: r["c"] for r in rows}
    assert all("".join(cut[n]) == t for n, t in enumerate(texts))
    assert all(len(c) <= recipes.MOST_CHUNK + 2 for cs in cut.values() for c in cs)
    # A passage is cut alike wherever it stands.
    assert len(set(cut[0]) & set(cut[1])) > 0.95 * len(set(cut[0]))
    assert len(cut[0]) > 100


def test_hot_group_missing_ids_repeated_rows_and_no_rows(spark):
    rows = [(n, "hot text " * 30) for n in range(500)] + [(n, f"other {n}") for n in range(500, 900)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, [(None, "a"), (None, "a"), (4, "b"), (4, "b"), (None, "b")]) == sorted(
        brute([(None, "a"), (None, "a"), (4, "b"), (4, "b"), (None, "b")]), key=str
    )
    assert found(spark, []) == []


def test_bytes_that_are_no_text(spark):
    rows = spark.createDataFrame([(1, bytearray(b"a\xff" * 40)), (2, bytearray(b"a\xfe" * 40)), (3, bytearray(b"a\xff" * 40))], "doc_id long, raw binary")
    texts = rows.select("doc_id", F.col("raw").cast("string").alias("text"))
    assert {r["doc_id"]: r["keep_id"] for r in recipes.exact_duplicates(texts).collect()} == {1: 3, 2: 2, 3: 3}


def test_recipes_need_no_python_worker_and_no_shuffle_of_texts(spark):
    rows = documents(spark, [(1, "a"), (2, "b")]).select("doc_id", "text", F.monotonically_increasing_id().alias("row_no"))
    plan = recipes.with_recipes(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
