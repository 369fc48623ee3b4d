import random

import numpy as np
import xxhash

from helpers import by_id, documents, prose
from ledgerloom.llm import simhash
from ledgerloom.llm.components import components


def plain_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    words = [w for w in text.split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_links_equal_brute_force(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(300)]
    near = [x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))) for x in base for _ in range(3)]
    prints = sorted({x - (1 << 64) if x >> 63 else x for x in base + near})
    table = spark.createDataFrame([(x,) for x in prints], "fp long")
    found = {(r["a"], r["b"]) for r in simhash.links(table).collect()}
    values = np.array(prints, np.int64).view(np.uint64)
    close = np.bitwise_count(values[:, None] ^ values[None, :]) <= 3
    wanted = {(prints[i], prints[j]) for i, j in zip(*np.nonzero(close)) if i < j}
    assert len(wanted) > 500 and found == wanted


def test_fingerprints_groups_and_odd_rows(spark):
    rng = random.Random(6)
    words = ["alpha", "Beta", "gamma", "ÄÖ", "delta", "x1", "omega", "ß"]
    rows = [(i, prose(rng, words, 40 + i)) for i in range(10, 30)]
    rows += [(5, None), (6, ""), (7, " \t\n"), (8, "one word"), (9, "two words")]
    rows += [(40, rows[3][1].upper() if rows[3][1].isascii() else rows[3][1]), (41, rows[4][1]), (41, rows[4][1]), (None, rows[4][1])]
    docs = documents(spark, rows, "fp fingerprint component_id root node kept_id copy_no a b")
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    prints = {}
    for r in found:
        prints.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    for i, text in rows:
        assert f"{plain_fingerprint(text):016x}" in prints[i]
    ids = {i: r for r in found if (i := r["doc_id"]) is not None}
    assert ids[5]["component_id"] == ids[6]["component_id"] == ids[7]["component_id"] == 5
    assert ids[5]["fingerprint"] == "0" * 16
    assert ids[41]["component_id"] == rows[4][0]
    assert [r["component_id"] for r in found if r["doc_id"] is None] == [None]
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert None not in ids and 41 not in ids and 6 not in ids and ids.count(5) == 1


def test_one_of_each_tells_rows_apart_by_id_and_text(spark):
    rng = random.Random(9)
    words = ["alpha", "beta", "gamma", "delta", "omega"]
    a, b, c, d = (prose(rng, words, 200) for _ in range(4))
    rows = [(1, a), (1, b), (1, b), (2, a), (None, c), (None, c), (None, d), (3, d), (4, None), (None, "")]
    kept = simhash.one_of_each(documents(spark, rows, "mark kept_id copy_no least root node fp kept_mark")).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted([(1, a), (1, b), (None, c), (3, d), (4, None)], key=str)
    assert simhash.one_of_each(documents(spark, [(None, "x")] * 5)).count() == 1


def test_empty_table(spark):
    docs = documents(spark, [])
    assert simhash.near_duplicates(docs).count() == 0 and simhash.one_of_each(docs).count() == 0


def test_a_chain_of_near_fingerprints_is_one_group(spark):
    prints = [(1 << (3 * i)) - 1 for i in range(20)]
    table = spark.createDataFrame([(x,) for x in prints], "fp long")
    links = simhash.links(table)
    assert links.count() == 19
    assert {r["root"] for r in components(links, "a", "b").collect()} == {0}
