import random
import re
import zlib
from collections import Counter

import pytest

from helpers import documents, prose
from ledgerloom.llm import spelling


def words_of(doc_id, text):
    for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
        h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
        if h % 31 == 0:
            p = h % len(low)
            low = low[:p] + low[p + 1 :]
        if len(low) >= 7:
            yield low


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    n = Counter(w for i, t in rows for w in words_of(i, t))
    n = {w: k for w, k in n.items() if k >= 2}
    near = {w: [v for v in n if one_apart(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def found(spark, rows, **options):
    result = [tuple(r) for r in spelling.spelling_variants(documents(spark, rows, "word n run form root code lots"), **options).collect()]
    assert len(result) == len(set(result))
    return set(result)


def edited(rng, word):
    letters = "abcdeéà÷"
    p = rng.randrange(len(word) + 1)
    return rng.choice([word[:p] + rng.choice(letters) + word[p:], word[:p] + word[p + 1 :], word[:p] + rng.choice(letters) + word[p + 1 :]])


@pytest.mark.parametrize("symbols,lot", [(4, 32), (2, 2), (9, 1)])
def test_against_brute_force(spark, monkeypatch, symbols, lot):
    monkeypatch.setattr(spelling, "LOT", lot)
    rng = random.Random(11)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(6, 11))) for _ in range(25)]
    common = base[:4]
    variants = [edited(rng, w) for w in base for _ in range(4)]
    further = [edited(rng, w) for w in variants[:40]]
    words = common * 300 + base * 30 + variants * 3 + further
    rows = [(n, prose(rng, words, 60)) for n in range(120)]
    rows += [(900, "Capital ÀCCENTS accents-accents " * 3), (901, "aaaaaaa aaaaaaaa aaaaaaa aaaaaaaa b" + "a" * 5000 + " b" + "a" * 5000)]
    rows += [(n, "chaining " * 400 + "chainings " * 40 + "chaininges " * 2) for n in range(910, 914)]
    expected = brute(rows)
    assert found(spark, rows, symbols=symbols) == expected
    assert any(root != form for _, form, root, *_ in expected if form) and any(form is None for _, form, *_ in expected)


def test_odd_rows(spark):
    rows = [(None, "missing missing"), (1, None), (2, ""), (3, "short words"), (4, "7 digits1234567 _"), (5, "repeated"), (5, "repeated")]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == set()


def test_ties_go_to_the_first_in_order_of_code_points(spark):
    rows = [(n, "housing nousing éousing") for n in range(40)] + [(100, "mousing"), (101, "mousing")]
    result = {r[0]: r for r in found(spark, rows)}
    assert result == {r[0]: r for r in brute(rows)}


def test_roots_follow_chains_of_any_length(spark):
    chain = [(f"w{n:02}", f"w{n + 1:02}") for n in range(19)]
    roots = {r["word"]: r["root"] for r in spelling._roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert roots == {w: "w19" for w, _ in chain}
