"""Exact duplicates by content-defined chunk recipes.

A text is cut into chunks at places that its own characters set, so a passage that many texts share is cut alike in
all of them. Every distinct chunk is moved once, to be compared with the chunks of equal hash: the hash, and a number
that tells chunks of one hash apart, is the chunk's verified identifier. A document is from then on its recipe, the
ordered list of identifiers, about one thirtieth of its text. Two texts are equal if and only if their recipes are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, settle
from ledgerloom.session import scratch_path

# Characters of a chunk: it ends at the first cut place behind the least, and anywhere at the most.
LEAST_CHUNK, MOST_CHUNK = 64, 4096
Hash = Callable[[Column], Column]


def _letters(rest: int) -> str:
    """The printable characters of Latin-1 whose code leaves this rest, as part of a character class."""
    return "".join(f"\\x{{{c:X}}}" for c in (*range(0x21, 0x7F), *range(0xA1, 0x100)) if c % 11 == rest)


# A cut place: white space behind one of a few letters behind one of a few others, or a mark or white space behind a
# character beyond Latin-1. About one word in sixty ends at one.
CUT_PLACE = rf"(?:[{_letters(0)}][{_letters(1)}]\s|[^\x{{0}}-\x{{FF}}][\s\p{{P}}])"
CHUNK_PATTERN = rf"(?s).{{{LEAST_CHUNK},{MOST_CHUNK}}}?{CUT_PLACE}|(?s).{{1,{MOST_CHUNK}}}"


def chunks_of(text: Column) -> Column:
    """The chunks of a text, which together are the text; none for an empty one."""
    # Bytes that are no UTF-8 would not outlive the pattern: such a text is one chunk.
    whole = F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(F.array(text))
    return F.when(F.is_valid_utf8(text), F.regexp_extract_all(text, F.lit(CHUNK_PATTERN), F.lit(0))).otherwise(whole)


def shared_hashes(chunks: DataFrame) -> DataFrame:
    """Hashes (hash) that different chunks of ``chunks`` (hash, chunk) have.

    Chunks shrink in the map tasks to distinct ones, which are shuffled once; after that only hashes are counted.
    """
    distinct = chunks.groupBy("hash", "chunk").agg(F.count(F.lit(1)).alias("uses"))
    return distinct.groupBy("hash").agg(F.count(F.lit(1)).alias("contents")).filter(F.col("contents") > 1).select("hash")


def with_recipes(rows: DataFrame, hash_of: Hash = F.xxhash64) -> DataFrame:
    """``rows`` (row_no, text, ...) with column recipe in place of the text.

    A recipe holds the chunks' hashes in order, and the places and variant numbers of chunks that share a hash with
    other chunks. Those are few or none: of 10^11 chunks about 300. Their hashes are stored, and only if there are any,
    the chunks that have them are put in order and joined.
    """
    spark = rows.sparkSession
    value = F.coalesce("text", F.lit(""))
    chunks = rows.select(F.explode(chunks_of(value)).alias("chunk")).select(hash_of(F.col("chunk")).alias("hash"), "chunk")
    path = scratch_path(spark, "shared_hashes")
    shared_hashes(chunks).write.parquet(path)
    shared = spark.read.schema("hash long").parquet(path)
    found = rows.withColumn("hashes", F.transform(chunks_of(value), lambda c: hash_of(c))).drop("text")
    none = F.array().cast("array<struct<at: int, variant: int>>")
    if shared.isEmpty():
        found = found.withColumn("variants", none)
    else:
        told = chunks.join(shared, "hash", "left_semi").distinct()
        told = told.withColumn("variant", F.row_number().over(Window.partitionBy("hash").orderBy("chunk")))
        seen = rows.select("row_no", F.posexplode(chunks_of(value)).alias("at", "chunk")).withColumn("hash", hash_of(F.col("chunk")))
        variants = (
            seen.join(told, ["hash", "chunk"])
            .groupBy(F.col("row_no").alias("of_row"))
            .agg(F.sort_array(F.collect_list(F.struct("at", "variant"))).alias("variants"))
        )
        found = found.join(variants, F.col("row_no") == F.col("of_row"), "left").drop("of_row")
    return found.withColumn("recipe", F.struct("hashes", F.coalesce("variants", none).alias("variants"))).drop("hashes", "variants")


def exact_duplicates(docs: DataFrame, hash_of: Hash = F.xxhash64) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row; rows of equal texts are a group.

    keep_id is the group's largest doc_id, and the row with it stays (kept). NULL counts as the empty text, which is a
    text like any other. A NULL doc_id is below all others; where a group has no other, keep_id is NULL and one row
    stays. Of repeated rows one stays: the group size counts them all. Texts are compared byte by byte, with no change.
    Texts of any length are cut whole. Other columns are ignored.

    A text is read where it lies, and moves only as distinct chunks. Groups shrink in the map tasks, and the join that
    gives every row its group is one that adaptive execution splits where a group holds much of the table.
    """
    settle(docs.sparkSession)
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row_no"))
    sha = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    made = cut(with_recipes(rows.withColumn("text_sha256", sha), hash_of))
    groups = made.groupBy("recipe").agg(
        F.count(F.lit(1)).alias("group_size"),
        # The last of the rows with the largest id, by one comparison.
        F.max(F.struct("doc_id", "row_no")).alias("last"),
    )
    return made.join(groups, "recipe").select(
        "doc_id",
        F.col("last.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_no") == F.col("last.row_no")).alias("kept"),
        "text_sha256",
    )
