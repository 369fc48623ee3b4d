"""Homomorphic multiset fingerprints of documents.

A document is a multiset of paragraphs (its lines that are not blank). Every paragraph is hashed to a wide vector of
lanes, and the fingerprint is the sum of the vectors, each lane modulo a power of two. So paragraphs can come in any
order, be added with ``+`` and taken away with ``-`` without reading the others. A paragraph's vector has 24 lanes
modulo 2^20 drawn from a hash of the whole paragraph, which tell multisets apart, and 64 lanes modulo 2^62 that count
the set bits of the hashes of its runs of four words, one from every word on, which show how much two documents share.
A word put in or taken out changes the runs that reach over it, and no others.

Three of the 24 lanes share a long, each with a spare bit that takes the carry of a sum before it is cleared. Each of
the 64 has a long of its own, behind them comes the number of runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import free_name, settle
from ledgerloom.llm.ordering import with_following

LANE_BITS = 20
SHIFTS = (0, LANE_BITS + 1, 2 * LANE_BITS + 2)
LANE = (1 << LANE_BITS) - 1
MASK = sum(LANE << s for s in SHIFTS)
ONES = sum(1 << s for s in SHIFTS)
EXACT_LONGS = 8
COUNT_BITS = 62
COUNTED = 64
# The lowest bit of every byte of a long, and how many such bits a byte can add up.
BYTE_ONES = sum(1 << s for s in range(0, 64, 8))
RUNS_PER_BLOCK = 127
# At the start of every word: it and up to three words behind it in the line, looked at without being used up.
RUN_PATTERN = r"(?<!\S)(?=(\S+(?:[ \t]+\S+){0,3}))\S"
# Copies of a row that are written out at a time.
COPIES_AT_A_TIME = 10_000


def _by_lanes(a: Column, b: Column, exact, counts) -> Column:
    """``exact`` of the longs of three lanes, ``counts`` of the others."""
    parts = [(F.slice(x, 1, EXACT_LONGS), F.slice(x, EXACT_LONGS + 1, COUNTED + 1)) for x in (a, b)]
    (a_exact, a_counts), (b_exact, b_counts) = parts
    return F.concat(F.zip_with(a_exact, b_exact, exact), F.zip_with(a_counts, b_counts, counts))


def add(a: Column, b: Column) -> Column:
    """Fingerprint of two multisets together."""
    wide = F.lit((1 << COUNT_BITS) - 1)
    return _by_lanes(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(MASK)), lambda x, y: (x + y).bitwiseAND(wide))


def take_away(a: Column, b: Column) -> Column:
    """Fingerprint of ``a`` without the paragraphs of ``b``."""
    # Adding the modulus to each lane first keeps it from going below zero.
    wide, size = F.lit((1 << COUNT_BITS) - 1), F.lit(1 << COUNT_BITS)
    return _by_lanes(
        a, b, lambda x, y: (F.lit(ONES << LANE_BITS) + x - y).bitwiseAND(F.lit(MASK)), lambda x, y: (size + x - y).bitwiseAND(wide)
    )


def _blocks(values: Column) -> Column:
    """``values`` in arrays of at most RUNS_PER_BLOCK."""
    n = F.size(values)
    starts = F.sequence(F.lit(0), n - 1, F.lit(RUNS_PER_BLOCK))
    inside = lambda at: F.sequence(at, F.least(at + RUNS_PER_BLOCK, n) - 1)
    return F.when(n == 0, F.array().cast("array<array<bigint>>")).otherwise(
        F.transform(starts, lambda at: F.transform(inside(at), lambda i: F.get(values, i)))
    )


def _byte_sum(block: Column, bit: int) -> Column:
    """How often bit ``bit`` of each byte is set in a block of hashes, in the bytes of a long."""
    return F.aggregate(block, F.lit(0).cast("long"), lambda total, v: total + F.shiftrightunsigned(v, bit).bitwiseAND(F.lit(BYTE_ONES)))


def _lane_sum(sums: Column, bit: int, byte: int) -> Column:
    return F.aggregate(
        sums,
        F.lit(0).cast("long"),
        lambda total, s: total + F.shiftrightunsigned(F.get(s, F.lit(bit)), 8 * byte).bitwiseAND(F.lit(255)),
    )


def _exact_sum(lines: Column, seed: int) -> Column:
    return F.aggregate(
        lines,
        F.lit(0).cast("long"),
        lambda total, line: (total + F.xxhash64(F.lit(seed), line).bitwiseAND(F.lit(MASK))).bitwiseAND(F.lit(MASK)),
    )


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the fingerprint of column ``text`` as an array of longs; NULL counts as empty, all zero."""
    names = [*df.columns, name]
    lines, runs, blocks, sums = (free_name(names, n) for n in ("lines", "runs", "blocks", "sums"))
    value = F.coalesce(F.col(text), F.lit(""))
    # Hashes are made once and then read by many sums, so they are columns of their own; so are the sums of blocks,
    # which count eight lanes in one walk.
    hashed = df.withColumns(
        {
            lines: F.filter(F.split(value, "\n"), lambda line: F.trim(line) != ""),
            runs: F.transform(F.regexp_extract_all(value, F.lit(RUN_PATTERN), F.lit(1)), lambda run: F.xxhash64(run)),
        }
    )
    hashed = hashed.withColumn(blocks, _blocks(F.col(runs)))
    hashed = hashed.withColumn(sums, F.transform(blocks, lambda block: F.array(*(_byte_sum(block, n) for n in range(8)))))
    exact = [_exact_sum(F.col(lines), n) for n in range(EXACT_LONGS)]
    counts = [_lane_sum(F.col(sums), bit, byte) for byte in range(8) for bit in range(8)]
    return hashed.withColumn(name, F.array(*exact, *counts, F.size(runs).cast("long"))).drop(lines, runs, blocks, sums)


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def _signed(fingerprint: Column) -> Column:
    """The 64 counting lanes as sums of plus and minus ones."""
    half, size = F.lit(1 << (COUNT_BITS - 1)), F.lit(1 << COUNT_BITS)
    # What was taken away without being there counts below zero.
    number = lambda x: F.when(x >= half, x - size).otherwise(x).cast("double")
    count = number(F.element_at(fingerprint, -1))
    return F.transform(F.slice(fingerprint, EXACT_LONGS + 1, COUNTED), lambda x: 2 * number(x) - count)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def with_likeness(df: DataFrame, left: str, right: str, name: str) -> DataFrame:
    """Add the cosine of two fingerprints' counting lanes, from 0 to 1; equal ones are 1, an empty and a full one 0."""
    a, b = free_name([*df.columns, name], "lanes_a"), free_name([*df.columns, name], "lanes_b")
    lanes = df.withColumns({a: _signed(F.col(left)), b: _signed(F.col(right))})
    norm = F.sqrt(_dot(F.col(a), F.col(a)) * _dot(F.col(b), F.col(b)))
    cosine = F.when(norm > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), _dot(F.col(a), F.col(b)) / norm))).otherwise(F.lit(0.0))
    return lanes.withColumn(name, F.when(F.col(left) == F.col(right), F.lit(1.0)).otherwise(cosine)).drop(a, b)


def with_next_row(rows: DataFrame, key: str) -> DataFrame:
    """For each distinct ``row_key`` of ``rows`` (key, row_key, n_chars): copies, n_chars, the row_key next by ``key``.

    NULL keys are last, rows of one key follow one another by row_key; after the last comes the first. Only keys are put in order, in
    ranges that Spark draws and stores; a key that holds any share of the rows is spread over as many ranges.
    """
    place = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col("row_key"))
    light = rows.groupBy(key, "row_key").agg(F.count(F.lit(1)).alias("copies"), F.max("n_chars").alias("n_chars"))
    light = light.select("row_key", "copies", "n_chars", place.alias("place"), F.lit(0).alias("whole"))
    light = with_following(light, "whole", "place", "row_key", "next_key", "is_first")
    start = light.agg(F.min("place").alias("place")).select("place.row_key").scalar()
    return light.select("row_key", "copies", "n_chars", F.coalesce("next_key", start).alias("next_key"))


def _copies(rows: DataFrame, times: str) -> DataFrame:
    """Each row as often as ``times`` says, without an array of that length."""
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.col(times) - 1, F.lit(COPIES_AT_A_TIME).cast("long"))).alias("at")
    some = rows.select("*", at)
    inside = F.sequence(F.col("at"), F.least(F.col("at") + COPIES_AT_A_TIME, F.col(times)) - 1)
    return some.withColumn("at", F.explode(inside)).drop("at", times)


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness and that to the next text.

    The edited text has the last quarter of the code points replaced by the first as many of the next document by
    doc_id. A NULL text counts as empty. Rows without doc_id come last, rows of one doc_id in the order of a hash of
    id and text; a lone document is its own next. Blank lines and blanks at a line's end leave the likeness alone, and
    blank lines the fingerprint too. Texts of blanks only have the fingerprint zero. Other columns are ignored.

    A row and its copies are one until the end. Its text moves once; the part of it that another row takes and its
    fingerprint visit that row.
    """
    settle(docs.sparkSession)
    rows = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text")
    rows = rows.withColumn("row_key", F.sha2(name, 256))
    size = F.char_length("text")
    part = F.floor(F.col("n_chars") / 4).cast("int")
    order = with_next_row(rows.select("doc_id", "row_key", size.alias("n_chars")), "doc_id")
    # One struct: both joins below read the same columns, so the texts are fingerprinted and shuffled once for both.
    whole = F.first(F.struct("doc_id", "text", "own")).alias("whole")
    own = with_fingerprint(rows, "text", "own").groupBy("row_key").agg(whole)
    asked = order.select(F.col("next_key").alias("row_key"), F.col("row_key").alias("asked_by"), part.alias("part"))
    given = own.join(asked, "row_key").select(
        F.col("asked_by").alias("row_key"),
        F.substring("whole.text", F.lit(1), F.col("part")).alias("next_part"),
        F.col("whole.own").alias("next_own"),
    )
    known = own.join(order, "row_key").select("row_key", "copies", "n_chars", "whole.*")
    by_next = F.struct("next_part", "next_own", F.lit(1).cast("long").alias("times"))
    # All copies but the last are followed by one like them.
    by_itself = F.struct(F.substring("text", F.lit(1), part).alias("next_part"), F.col("own").alias("next_own"), (F.col("copies") - 1).alias("times"))
    both = F.when(F.col("copies") > 1, F.array(by_next, by_itself)).otherwise(F.array(by_next))
    rows = known.join(given, "row_key").select("doc_id", "text", "n_chars", "own", F.inline(both))
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars") - part), "next_part")
    rows = rows.select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), "own", "next_own", "times", edited.alias("edited"))
    rows = with_fingerprint(rows, "edited", "changed").withColumn("edited_sha256", F.sha2("edited", 256)).drop("edited")
    rows = with_likeness(rows, "own", "changed", "near_edited")
    rows = with_likeness(rows, "own", "next_own", "near_next")
    rows = rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_hex(F.col("own")).alias("fingerprint"),
        as_hex(F.col("changed")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        "times",
    )
    return _copies(rows, "times")
