"""Small tables of documents, and plain ways to compute what the operators return."""

from __future__ import annotations

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, more=""):
    """Documents from (doc_id, text) or (doc_id, text, lang, source); ``more`` adds clashing columns, all zero."""
    full = [(*r, *((None, "a")[len(r) - 2 :] if len(r) < 4 else ())) for r in rows]
    table = spark.createDataFrame([(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in full], DOCUMENTS)
    for name in more.split():
        table = table.selectExpr("*", f"0 as `{name}`")
    return table


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def prose(rng, words, size):
    return " ".join(rng.choice(words) for _ in range(size))
