"""Spelling variants of the words of a corpus, found over a reduced alphabet.

Letters are hashed to a few symbols. Words one edit apart have reduced words at most one edit apart: an edit that
keeps the symbol leaves the reduced word as it is. Of two reduced words one edit apart, one holds the other among its
words with a letter less, or both have the same length and differ in one symbol; so every pair comes out of the
neighbourhood of one of its sides, made of the word itself, its deletions and its replacements by a higher symbol, and
insertions are the deletions of the other side. Neighbourhoods are joined with the reduced vocabulary, and the
original words that meet are compared letter by letter.

With few symbols the vocabulary shares few reduced words and few neighbourhoods are made; with many, fewer words meet
that are not near. The result is the same for any number of symbols.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, settle

RUN_PATTERN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A run loses a letter if this divides its hash.
LOSING = 31
LEAST_LENGTH, LEAST_USES = 7, 2
# A form occurs at least so many times as often as its variant.
FORM_FACTOR = 10
SYMBOLS = 4
# Words of one reduced word that travel together, on average; more are dealt to several such lots.
LOT = 32
LETTERS = LOWER + "".join(map(chr, range(0xC0, 0x100)))


def runs_of(text: Column, least: int) -> Column:
    """Maximal runs of letters with at least ``least`` letters."""
    return F.regexp_extract_all(text, F.lit(RUN_PATTERN.replace("+", f"{{{least},}}")), F.lit(0))


def vocabulary(docs: DataFrame) -> DataFrame:
    """word and n (occurrences) of every word of ``docs`` (doc_id, text): see :func:`spelling_variants`.

    Occurrences shrink to words in the map tasks.
    """
    runs = docs.select("doc_id", F.explode(runs_of(F.col("text"), LEAST_LENGTH)).alias("run"))
    # Translating letter by letter is slow, and few runs have capitals.
    run = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run"))
    low = runs.select("doc_id", run.alias("run"))
    mark = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    marked = low.select("run", mark.alias("mark"))
    at = F.pmod("mark", F.char_length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    words = marked.select(F.when(F.col("mark") % LOSING == 0, less).otherwise(F.col("run")).alias("word"))
    return (
        words.filter(F.char_length("word") >= LEAST_LENGTH)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= LEAST_USES)
    )


def reduced(word: Column, symbols: int) -> Column:
    """The word with every letter replaced by one of ``symbols`` digits."""
    digits = "".join(str(zlib.crc32(letter.encode()) % symbols) for letter in LETTERS)
    return F.translate(word, LETTERS, digits)


def _neighbourhood(word: Column, symbols: int) -> Column:
    """Hashes of a reduced word, its deletions and its replacements by a higher symbol."""

    def around(at: Column) -> Column:
        left, right = F.substring(word, F.lit(1), at - 1), F.substring(word, at + 1, F.length(word))
        here = F.substring(word, at, F.lit(1)).cast("int")
        higher = [F.when(here < s, F.xxhash64(F.concat(left, F.lit(str(s)), right))) for s in range(1, symbols)]
        return F.array(F.xxhash64(F.concat(left, right)), *higher)

    every = F.flatten(F.transform(F.sequence(F.lit(1), F.length(word)), around))
    return F.array_distinct(F.concat(F.array(F.xxhash64(word)), F.array_compact(every)))


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """Pairs (word, n, near, near_n) of words one letter put in, taken out or replaced apart, each both ways.

    ``words`` (word, n) holds every word once. Words of one reduced word travel in lots of about LOT words, whose
    number follows from their count, so no row grows with the vocabulary.
    """
    coded = words.select("word", "n", reduced(F.col("word"), symbols).alias("code"))
    sizes = coded.groupBy("code").agg(F.ceil(F.count(F.lit(1)) / LOT).alias("lots"))
    lots = cut(
        coded.join(sizes, "code")
        .groupBy("code", F.pmod(F.xxhash64("word"), F.col("lots")).alias("lot"))
        .agg(F.collect_list(F.struct("word", "n")).alias("members"))
    )
    makers = lots.select(F.col("members").alias("mine"), F.explode(_neighbourhood(F.col("code"), symbols)).alias("key"))
    met = makers.join(lots.select(F.xxhash64("code").alias("key"), "members"), "key")
    one = met.select(F.explode("mine").alias("a"), "members").select("a", F.explode("members").alias("b"))
    apart = F.levenshtein("a.word", "b.word", 1) == 1
    # Words of one reduced word, or of equal hashes, meet more than once.
    pairs = one.filter(apart).select(
        F.least("a.word", "b.word").alias("low"),
        F.greatest("a.word", "b.word").alias("high"),
        F.when(F.col("a.word") < F.col("b.word"), F.col("a.n")).otherwise(F.col("b.n")).alias("low_n"),
        F.when(F.col("a.word") < F.col("b.word"), F.col("b.n")).otherwise(F.col("a.n")).alias("high_n"),
    ).distinct()
    both = F.array(
        F.struct(F.col("low").alias("word"), F.col("low_n").alias("n"), F.col("high").alias("near"), F.col("high_n").alias("near_n")),
        F.struct(F.col("high").alias("word"), F.col("high_n").alias("n"), F.col("low").alias("near"), F.col("low_n").alias("near_n")),
    )
    return pairs.select(F.inline(both))


def _roots(forms: DataFrame) -> DataFrame:
    """word and root of every row of ``forms`` (word, form): the last word reached through forms.

    A form occurs ten times as often as its variant, so chains are short and have no rings; each round doubles the
    steps a root is away.
    """
    found = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = found.select(F.col("word").alias("of_word"), F.col("root").alias("of_root"))
        if found.join(onward, F.col("root") == F.col("of_word"), "left_semi").isEmpty():
            return found
        found = cut(
            found.join(onward, F.col("root") == F.col("of_word"), "left").select("word", F.coalesce("of_root", "root").alias("root"))
        )


def spelling_variants(docs: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the texts.

    The runs of letters of a text are lower-cased from A to Z. A run whose crc32, taken with its doc_id, is divided
    by 31 has lost a letter. Words are what is left with at least seven letters and at least two occurrences (n). A
    word's form is its near word of the largest n, of several the first in order of code points, if it occurs at least
    ten times as often. NULL and empty texts have no words; a NULL doc_id counts as an empty one. Repeated rows count
    as often as they occur. Long texts and long runs are read whole. Other columns are ignored.
    """
    settle(docs.sparkSession)
    words = cut(vocabulary(docs))
    often = F.col("near_n") >= FORM_FACTOR * F.col("n")
    best = F.min(F.when(often, F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("form"))))
    near = cut(
        near_words(words, symbols)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
        .select(F.col("word").alias("of_word"), "n_near", "best.form", (-F.col("best.rank")).alias("form_n"))
    )
    roots = _roots(near.filter(F.col("form").isNotNull()).select(F.col("of_word").alias("word"), "form"))
    named = near.join(roots.withColumnRenamed("word", "rooted"), F.col("of_word") == F.col("rooted"), "left")
    return words.join(named, F.col("word") == F.col("of_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"
    )
