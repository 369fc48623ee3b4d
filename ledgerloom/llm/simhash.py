"""SimHash near-duplicates found around the anchors of a covering code.

A pair of fingerprints that differ in at most three bits differs in at most one bit of its low or of its high
32 bits. On each half the anchors are the words of a perfect Hamming code on 31 bits, taken with either value
of the last bit: every half lies within one bit of an anchor (the covering radius). A fingerprint is sent to
every anchor within that radius plus the one differing bit; its nearest anchor is its home. Of two halves that
differ in one bit, the second reaches the home of the first, so comparing homes with visitors at each anchor
finds every linked pair.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, free_name, settle, ship
from ledgerloom.llm.components import components

SEED = 42
SHINGLE = 3
MAX_BITS = 3
# Shingles whose bits are counted at a time.
BLOCK = 1 << 16


def shingle_hashes(text: str | None) -> np.ndarray:
    """XXH64 of every 3-word shingle; fewer words count as one shingle, no word as none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z, only ASCII space
    if len(words) < SHINGLE:
        shingles, n = ([b" ".join(words)], 1) if words else ([], 0)
    else:
        shingles, n = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)))), len(words) - SHINGLE + 1
    return np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles), np.uint64, n)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes; zero for none. As a signed 64-bit number."""
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), BLOCK):
        block = hashes[start : start + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint(text: Column) -> Column:
    """64-bit SimHash of a text as a signed long; zero for NULL and for no words."""

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([majority(shingle_hashes(t)) for t in texts], dtype="int64")

    return simhash(text)


def as_hex(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _steps() -> list[tuple[list[int], int]]:
    """For each syndrome: the changes of a 32-bit half that lead to its anchors, and the one that leads home.

    Positions 1..31 of the Hamming code are the bits 0..30; the syndrome is the XOR of the positions set.
    """
    out = []
    for s in range(32):
        home = 1 << (s - 1) if s else 0
        ball = {home, home ^ (1 << 31)}
        for i in range(1, 32):
            j = i ^ s
            if s and j and i < j:  # two bits whose positions cancel the syndrome
                ball.add((1 << (i - 1)) | (1 << (j - 1)))
        out.append((sorted(ball), home))
    return out


def _syndrome(half: Column) -> Column:
    value = F.lit(0)
    for bit in range(5):
        mask = sum(1 << (p - 1) for p in range(1, 32) if p >> bit & 1)
        value = value + (F.bit_count(half.bitwiseAND(F.lit(mask))) % 2) * (1 << bit)
    return value


def links(prints: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints in column ``fp`` with at most three differing bits."""
    steps = _steps()
    balls = F.array(*(F.array(*(F.lit(x).cast("long") for x in ball)) for ball, _ in steps))
    homes = F.array(*(F.lit(home).cast("long") for _, home in steps))
    parts = prints.select(
        "fp",
        F.explode(
            F.array(
                *(
                    F.struct(F.lit(n << 32).alias("tag"), F.shiftrightunsigned("fp", 32 * n).bitwiseAND(F.lit(0xFFFFFFFF)).alias("half"))
                    for n in (0, 1)
                )
            )
        ).alias("part"),
    ).select("fp", F.col("part.tag").alias("tag"), F.col("part.half").alias("half"), _syndrome(F.col("part.half")).alias("s"))
    home = parts.select(
        F.col("tag").bitwiseOR(F.col("half").bitwiseXOR(F.element_at(homes, F.col("s") + 1))).alias("anchor"), F.col("fp").alias("x")
    )
    visitors = parts.select(
        "tag", "half", F.col("fp").alias("y"), F.explode(F.element_at(balls, F.col("s") + 1)).alias("step")
    ).select(F.col("tag").bitwiseOR(F.col("half").bitwiseXOR(F.col("step"))).alias("anchor"), "y")
    near = (F.col("x") != F.col("y")) & (F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= MAX_BITS)
    return (
        home.join(visitors, "anchor")
        .filter(near)
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .distinct()
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable) of every row.

    Rows with equal fingerprints shrink to one fingerprint before anything is compared. NULL and empty texts
    have fingerprint zero and link like any other. A row without doc_id is never linked: its component_id is
    NULL. Repeated rows come out as often as they go in. Other columns are ignored.
    """
    settle(docs.sparkSession)
    rows = cut(docs.select("doc_id", fingerprint(F.col("text")).alias("fp")))
    prints = rows.filter(F.col("doc_id").isNotNull()).groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    prints = cut(prints)
    roots = cut(components(links(prints), "a", "b"))
    rooted = prints.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )
    groups = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = rooted.join(groups, "root").select("fp", "component_id")
    return rows.join(named, "fp", "left").select(
        "doc_id",
        as_hex(F.col("fp")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each group of linked texts: the one with the smallest doc_id, NULL last, then by a hash of the text.

    Rows are told apart by doc_id and text. Two texts under one doc_id are two rows, each with its own group; rows
    without doc_id take part like others; of repeated rows one stays. All columns are kept.
    """
    settle(docs.sparkSession)
    mark, kept_id, kept_mark, rank = (free_name(docs.columns, n) for n in ("mark", "kept_id", "kept_mark", "copy_no"))
    text_mark = F.xxhash64(F.col("text").isNull(), F.coalesce("text", F.lit("")))
    rows = cut(docs.select("doc_id", fingerprint(F.col("text")).alias("fp"), text_mark.alias("mark")))
    prints = cut(rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("least")))
    roots = components(links(prints), "a", "b")
    rooted = prints.join(roots, F.col("fp") == F.col("node"), "left").select("least", F.coalesce("root", "fp").alias("root"))
    kept = rooted.groupBy("root").agg(F.min("least").alias("least")).select(
        F.col("least.doc_id").alias(kept_id), F.col("least.mark").alias(kept_mark)
    )
    marked = docs.withColumn(mark, text_mark)
    chosen = marked.join(kept, F.col("doc_id").eqNullSafe(F.col(kept_id)) & (F.col(mark) == F.col(kept_mark)), "left_semi")
    # Only repeated rows are left to tell apart; Spark keeps one of each in every map task.
    first = Window.partitionBy("doc_id", mark).orderBy(F.lit(1))
    return chosen.withColumn(rank, F.row_number().over(first)).filter(F.col(rank) == 1).drop(rank, mark)


ship(__name__)
