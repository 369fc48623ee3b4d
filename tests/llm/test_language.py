import random
import string
import zlib

from helpers import by_id, documents
from ledgerloom.llm import language


def test_held_out_accuracy_and_every_row(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found, truth = by_id(language.identify(docs)), by_id(docs)
    assert set(found) == set(truth)
    tested = [i for i in found if found[i]["held_out"]]
    assert all(found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in found)
    right = sum(found[i]["lang_pred"] == truth[i]["lang"] for i in tested)
    assert right / len(tested) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_odd_rows(spark, folder):
    learned = [(r["doc_id"], r["text"], r["lang"], None) for r in spark.read.parquet(f"{folder}/documents.parquet").limit(60).collect()]
    odd = [(10_000, None), (10_001, ""), (10_002, "123 !!! \n ²"), (10_003, "漢字 かな"), (None, learned[0][1]), (10_004, "a " * 50_000), (10_004, "a " * 50_000)]
    docs = documents(spark, learned + [(i, t, None, None) for i, t in odd], "score lang_pred identified p")
    rows = language.identify(docs).collect()
    found = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(learned) + len(odd)
    for i in (10_000, 10_001, 10_002):
        assert (found[i]["lang_pred"], found[i]["score"]) == ("und", 0.0)
    assert found[10_003]["lang_pred"] != "und" and found[None]["held_out"] is False
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert not {10_000, 10_001, 10_002} & set(ids) and ids.count(10_004) == 2


def test_nothing_to_learn_from(spark):
    docs = documents(spark, [(1, "some words"), (2, None)])
    assert {(r["lang_pred"], r["score"]) for r in language.identify(docs).collect()} == {("und", 0.0)}
    assert language.keep_identified(docs).count() == 2
    assert language.identify(documents(spark, [])).count() == 0


def test_code_switched_words_are_labelled_one_by_one():
    spanish, german = "la casa que el perro ladrando", "das haus und der hund bellt"
    model = language.train([spanish] * 20 + [german] * 20, ["es"] * 20 + ["de"] * 20)
    p = language.Labeller(model).probabilities([spanish, german, f"{spanish} {german}", "42"])
    assert p[0, model.labels.index("es")] > 0.9 and p[1, model.labels.index("de")] > 0.9
    assert 0.25 < p[2, 0] < 0.75 and p[3].sum() == 0


def test_text_of_no_learned_language_goes(spark, folder):
    learned = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    rng = random.Random(4)
    gibberish = " ".join("".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randint(2, 9))) for _ in range(200))
    of = {r["lang"]: r["text"][:400] for r in learned if r["lang"] and len(r["text"]) > 500}
    assert len(of) == 4
    away = ["漢字 かな 日本語 の 文章 です", "это текст на русском языке о погоде", "wczoraj wieczorem poszliśmy do kina żeby obejrzeć film", "asdkfjh qwoeiru zxmcnvb asdlkfj", gibberish]
    stay = ["\n".join(of.values()), " ".join(x for line in zip(*(t.split() for t in of.values())) for x in line), f"{of['en']}\n{gibberish[:200]}"]
    docs = documents(spark, [tuple(r) for r in learned] + [(20_000 + n, t, None, None) for n, t in enumerate(away + stay)])
    found = by_id(language.identify(docs))
    assert [found[20_000 + n]["score"] for n in range(len(away))] == [0.0] * len(away)
    ids = {r["doc_id"] for r in language.keep_identified(docs).collect()}
    assert ids == set(by_id(docs)) - {20_000 + n for n in range(len(away))}


def test_words_behind_the_fortieth_of_a_line_are_learned(monkeypatch):
    seen = []
    spelling = language.learn_spelling
    monkeypatch.setattr(language, "learn_spelling", lambda words: seen.extend(words) or spelling(words))
    text = " ".join(f"w{chr(97 + n // 26)}{chr(97 + n % 26)}" for n in range(100))
    language.train([text, "other words"], ["a", "b"])
    assert set(language.words_of(text)) <= set(seen)
