"""Token counts without token ids.

The vocabulary has no piece with a space behind another character and none with a line break, so the pieces of a
text are those of its pre-tokens: a run of spaces with the characters up to the next space or line break, or a
line break. Every distinct pre-token is counted once and joined to the documents' pre-token frequencies; only sums
remain.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, settle, ship

TOKEN_LIMIT = 4096
SPACE_MARK = "▁"  # what the vocabulary writes for a space
PRE_TOKEN = r"[ ]*[^ \n]+|[ ]+|\n"
# No pre-token: it stands for the row itself, so that rows without tokens are counted too.
ROW = "\n\n"
# Pre-tokens that are frequent in a sample of about so many documents are counted first and looked up in a broadcast:
# at most so many short ones of at most so many bytes, and so many long ones. All others are joined by shuffle.
SAMPLE_DOCUMENTS = 20_000
FREQUENT, FREQUENT_BYTES = 1 << 18, 48
FREQUENT_LONG, LONG_BYTES = 1 << 10, 1 << 14
KEYS = ("doc_id", "n_bytes", "digest")
# Texts that are taken out of an Arrow batch at once, and frequencies after which a batch is given on.
TEXTS, BATCH = 64, 1 << 16


def count_pieces(words: list[str], processor: sentencepiece.SentencePieceProcessor) -> list[int]:
    """Pieces of each pre-token inside a text, where no mark is put before it."""
    # The library puts a space mark before what it encodes: it stands for a leading space, or is taken off again
    # together with the line break that keeps it apart.
    led = [w[1:] if w[0] == " " else w if w == "\n" else "\n" + w for w in words]
    counts = map(len, processor.encode(led, num_threads=1))
    return [max(1, n) if w[0] == " " else n - 1 if w == "\n" else n - 2 for w, n in zip(words, counts)]


def check_vocabulary(processor: sentencepiece.SentencePieceProcessor) -> None:
    """Refuse a vocabulary whose pieces reach over pre-tokens."""
    for n in range(processor.get_piece_size()):
        piece = processor.id_to_piece(n)
        if SPACE_MARK in piece.lstrip(SPACE_MARK) or "\n" in piece:
            raise ValueError(f"piece {n} reaches over pre-tokens")


def with_pieces(words: DataFrame, model: bytes) -> DataFrame:
    """``words`` (column w) with the number of pieces of each; equal words that follow each other are counted once."""
    sent = words.sparkSession.sparkContext.broadcast(model)
    kept: dict[str, sentencepiece.SentencePieceProcessor] = {}
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in words.schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if "it" not in kept:
            kept["it"] = sentencepiece.SentencePieceProcessor(model_proto=sent.value)
        last, last_pieces = None, 0
        for batch in batches:
            words = batch.column("w").dictionary_encode()
            distinct = words.dictionary.to_pylist()
            begun = len(distinct) > 0 and distinct[0] == last
            pieces = [last_pieces] * begun + count_pieces(distinct[int(begun) :], kept["it"])
            if distinct:
                last, last_pieces = distinct[-1], pieces[-1]
            yield batch.append_column("pieces", pa.array(pieces, pa.int64()).take(words.indices))

    return words.mapInArrow(count, f"{fields}, pieces long")


def frequencies(rows: DataFrame) -> DataFrame:
    """KEYS, w and n: how often each pre-token is in each row of ``rows`` (KEYS, found).

    The pre-tokens of a row are sorted and counted inside the row, so nothing is shuffled.
    """
    ordered = rows.select(*KEYS, F.sort_array("found").alias("ordered"), F.size("found").alias("size"))
    # Beyond the ends get() gives NULL, which no pre-token equals.
    places = F.filter(
        F.sequence(F.lit(0), F.greatest(F.col("size") - 1, F.lit(0))),
        lambda i: ~F.get("ordered", i).eqNullSafe(F.get("ordered", i - 1)),
    )
    begun = ordered.select(*KEYS, "ordered", "size", places.alias("places"))
    runs = F.transform(
        "places",
        lambda at, k: F.struct(
            F.get("ordered", at).alias("w"), (F.coalesce(F.get("places", k + 1), F.col("size")) - at).cast("long").alias("n")
        ),
    )
    return begun.select(*KEYS, F.inline(runs))


def text_frequencies(texts: DataFrame, frequent: Broadcast, long: bool) -> DataFrame:
    """KEYS, w and n: how often each pre-token that is not ``frequent`` (w: pieces) is in each row of ``texts`` (KEYS, text).

    Only those of over FREQUENT_BYTES with ``long``, else only the others; these come with a ROW for each row, whose n
    are the pieces of all its frequent pre-tokens. The pre-tokens of a row are counted inside the row.
    """
    found = re.compile(PRE_TOKEN)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces_of = frequent.value.get
        for batch in batches:
            rows, words, uses = [], [], []

            def taken(batch: pa.RecordBatch = batch) -> pa.RecordBatch:
                keys = [batch.column(k).take(pa.array(rows, pa.int32())) for k in KEYS]
                return pa.RecordBatch.from_arrays([*keys, pa.array(words, pa.string()), pa.array(uses, pa.int64())], [*KEYS, "w", "n"])

            for begin in range(0, batch.num_rows, TEXTS):
                for row, text in enumerate(batch.column("text").slice(begin, TEXTS).to_pylist(), begin):
                    known = 0
                    # An empty text gets no mark in front.
                    for w, n in Counter(found.findall(" " + text.replace(SPACE_MARK, " ")) if text else ()).items():
                        pieces = pieces_of(w)
                        if pieces is not None:
                            known += pieces * n
                        elif (4 * len(w) > FREQUENT_BYTES and len(w.encode()) > FREQUENT_BYTES) is long:
                            rows.append(row)
                            words.append(w)
                            uses.append(n)
                    if not long:
                        rows.append(row)
                        words.append(ROW)
                        uses.append(known)
                    if len(rows) >= BATCH:
                        yield taken()
                        rows, words, uses = [], [], []
            yield taken()

    key_types = ", ".join(f"{k} {texts.schema[k].dataType.simpleString()}" for k in KEYS)
    return texts.select(*KEYS, "text").mapInArrow(count, f"{key_types}, w string, n long")


def rare_pieces(others: DataFrame, model: bytes, long: DataFrame | None = None) -> DataFrame:
    """Frequencies (KEYS, w, n) with the pieces of each pre-token, counted once for each distinct one.

    Frequencies of a short pre-token move to where it is counted. Long ones may be in many rows and are too wide for
    that: the distinct texts move, and what is joined to their counts is a digest, which Spark splits if it is hot.
    ``long`` has the long ones if ``others`` has none. A ROW counts one piece and is dealt by its keys.
    """
    is_short, is_row = F.octet_length("w") <= FREQUENT_BYTES, F.col("w") == ROW
    short, digest = others, F.sha2("w", 256).alias("key")
    if long is None:
        short, long = others.where(is_short), others.where(~is_short)
    dealt = short.repartition("w", F.when(is_row, F.xxhash64(*KEYS)))
    met = with_pieces(dealt.sortWithinPartitions("w"), model).withColumn("pieces", F.when(is_row, 1).otherwise(F.col("pieces")))
    counted = cut(with_pieces(long.select("w").distinct(), model).select(digest, "pieces"))
    joined = long.select(*KEYS, "n", digest).join(counted, "key")
    return met.select(*KEYS, "n", "pieces", is_row.alias("is_row")).unionByName(
        joined.select(*KEYS, "n", "pieces", F.lit(False).alias("is_row"))
    )


def _at_most(counted: DataFrame, most: int) -> DataFrame:
    """The rows of ``counted`` with at least 2^k uses, for the least k that leaves at most ``most``."""
    sizes = counted.groupBy(F.floor(F.log2("uses")).cast("int").alias("power")).count().orderBy(F.desc("power")).collect()
    least, total = None, 0
    for power, n in sizes:
        total += n
        if total > most:
            break
        least = power
    return counted.limit(0) if least is None else counted.filter(F.col("uses") >= (1 << least))


def frequent_words(rows: DataFrame, documents: int) -> DataFrame:
    """Frequent pre-tokens of a sample of ``rows`` (KEYS, found), chosen by a hash of the text."""
    buckets = 1 << 30
    bound = min(buckets, -(-buckets * SAMPLE_DOCUMENTS // max(1, documents)))
    sample = frequencies(rows.filter(F.pmod(F.xxhash64("digest"), F.lit(buckets)) < bound))
    size = F.octet_length("w")
    counted = cut(sample.filter((F.col("w") != ROW) & (size <= LONG_BYTES)).groupBy("w").agg(F.sum("n").alias("uses")))
    short, long = counted.filter(size <= FREQUENT_BYTES), counted.filter(size > FREQUENT_BYTES)
    return _at_most(short, FREQUENT).unionByName(_at_most(long, FREQUENT_LONG)).select("w")


def repeated(rows: DataFrame, copies: str) -> DataFrame:
    """Every row as often as its column ``copies`` says, without that column; no array is longer than needed for a block."""
    block = 1 << 12
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({copies} - 1) div {block}")))
    kept = [c for c in rows.columns if c != copies]
    blocks = rows.select(*kept, copies, parts.alias("part"))
    within = F.least(F.col(copies) - F.col("part") * block, F.lit(block).cast("long"))
    return blocks.select(*kept, F.explode(F.sequence(F.lit(1).cast("long"), within)).alias("part")).drop("part")


def token_counts(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row; other columns are ignored.

    A NULL text counts as empty: no bytes and no tokens. Repeated rows come out as often as they go in. Which
    pre-tokens are looked up depends on a sample, what comes out does not: see :func:`rare_pieces` for
    the others.
    """
    settle(docs.sparkSession)
    with open(model_file, "rb") as f:
        model = f.read()
    check_vocabulary(sentencepiece.SentencePieceProcessor(model_proto=model))
    text = F.coalesce(F.col("text"), F.lit(""))
    spaced = F.concat(F.lit(" "), F.translate(text, SPACE_MARK, " "))
    # An empty text gets no mark in front.
    found = F.when(text == "", F.array().cast("array<string>")).otherwise(F.regexp_extract_all(spaced, F.lit(PRE_TOKEN), F.lit(0)))
    rows = docs.select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.xxhash64(text).alias("digest"),
        text.alias("text"), F.concat(F.array(F.lit(ROW)), found).alias("found"),
    )
    first = with_pieces(frequent_words(rows, docs.count()), model).toArrow()
    frequent = docs.sparkSession.sparkContext.broadcast(dict(zip(first["w"].to_pylist(), first["pieces"].to_pylist())))
    short, long = text_frequencies(rows, frequent, False), text_frequencies(rows, frequent, True)
    parts = rare_pieces(short, model, long)
    totals = parts.groupBy(*KEYS).agg(
        F.sum(F.col("pieces") * F.col("n")).alias("all_tokens"), F.count_if("is_row").alias("copies")
    )
    n_tokens = F.expr("all_tokens div copies")
    return repeated(
        totals.select("doc_id", "n_bytes", n_tokens.alias("n_tokens"), (n_tokens > TOKEN_LIMIT).alias("over_limit"), "copies"), "copies"
    )


ship(__name__)
