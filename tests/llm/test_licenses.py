import random
import re

from helpers import documents, prose
from pyspark.sql import functions as F
from ledgerloom.llm import licenses


def words(text):
    return re.findall("[a-z0-9]+", "".join(c.lower() if c.isascii() else " " for c in text or ""))


def brute(rows, templates):
    """(row, license) pairs whose template has four fifths of its shingles within a stretch of three of its lengths."""
    out = set()
    for n, (_, text) in enumerate(rows):
        own = words(text)
        for name, template in templates:
            t = words(template)
            k = min(5, len(t))
            wanted = {tuple(t[i : i + k]) for i in range(len(t) - k + 1)}
            seen = [tuple(own[i : i + k]) for i in range(len(own) - k + 1)]
            hits = [i for i, s in enumerate(seen) if s in wanted]
            for i in hits:
                if len({s for s in seen[i : i + len(wanted) + 4] if s in wanted}) >= 0.8 * len(wanted):
                    out.add((n, name))
                    break
    return out


def test_planted_templates(spark):
    rng = random.Random(8)
    vocabulary = ["license", "the", "version", "of", "work", "licensed", "under", "copy", "use", "and", "stone", "river", "any", "software"]
    rows = []
    for n in range(60):
        name, text = licenses.TEMPLATES[n % len(licenses.TEMPLATES)]
        body = text.split()
        if n % 3 == 1 and len(body) > 30:
            body[len(body) // 2] = "changed"
        before, after = prose(rng, vocabulary, rng.randint(0, 400)), prose(rng, vocabulary, rng.randint(0, 300))
        rows.append((n, f"{before}\n{' '.join(body).upper() if n % 4 == 0 else ' '.join(body)}\n{after}"))
    rows += [(100, None), (101, ""), (102, "MIT License"), (103, "all rights reserved"), (None, licenses.TEMPLATES[0][1]), (7, rows[7][1]), (104, prose(rng, vocabulary, 30_000))]
    docs = documents(spark, rows, "license words hits row_no h5 p5 hit sketch from")
    found = licenses.scan(docs).collect()
    wanted = brute(rows, licenses.TEMPLATES)
    pairs = sorted((-1 if rows[n][0] is None else rows[n][0], name) for n, name in wanted)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["license"]) for r in found) == pairs
    assert all(0.8 <= r["containment"] <= 1 for r in found)
    assert [r["first_word"] for r in found if r["doc_id"] == 103] == [0]


def test_real_documents(spark, folder):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = {(r["doc_id"], r["license"]) for r in licenses.scan(spark.read.parquet(f"{folder}/documents.parquet")).collect()}
    assert found == {(rows[n][0], name) for n, name in brute(rows, licenses.TEMPLATES)}


def test_no_rows(spark):
    assert licenses.scan(documents(spark, [])).count() == 0


def test_windows_that_share_enough_are_seldom_missed(spark):
    """Of 10,000 random templates of 6 to 60 words and windows with a Jaccard likeness of 0.45, bands miss below 1 in 1,000."""
    rng = random.Random(4)
    rows = []
    for n in range(10_000):
        own = rng.randint(6, 60) - 4
        window = licenses.window_of(own)
        if window <= licenses.EXACT_WINDOWS:
            continue
        shared = next(s for s in range(own + 1) if s >= 0.45 * (own + window - s))
        template = [rng.getrandbits(62) for _ in range(own)]
        rows.append((n, template, template[:shared] + [rng.getrandbits(62) for _ in range(window - shared)]))
    table = spark.createDataFrame(rows, "n int, template array<long>, other array<long>").repartition(8)
    sketches = table.select(*(licenses._sketch(F.col(c), licenses.BANDS).alias(c) for c in ("template", "other")))
    agree = F.exists(F.zip_with("template", "other", lambda a, b: a == b), lambda same: same)
    missed = sketches.filter(~agree).count()
    assert len(rows) > 9000 and missed <= 0.001 * len(rows)


def test_shingles_scattered_over_a_stretch_are_no_license(spark):
    template = licenses.TEMPLATES[7][1].split()
    runs = [" ".join(template[i : i + 9]) for i in range(0, len(template), 9)]
    scattered = (" filler" * 12 + " ").join(runs)
    found = licenses.scan(documents(spark, [(1, scattered), (2, " ".join(template))])).collect()
    assert [(r["doc_id"], r["license"]) for r in found if r["license"] == "MIT-text"] == [(2, "MIT-text")]
