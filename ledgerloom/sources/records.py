"""Records of CSV files with quoted line breaks, cut by many tasks.

Spark's own reader gives such a file to one task, because no task can tell from the middle of a file whether it
is inside quotes. Here the files are read as lines. Lines are counted in short chunks; the parity of the quotes
of all chunks before says whether a chunk begins inside quotes, and only lines of broken records meet again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A chunk holds at most 2**CHUNK_BITS lines of one split of a file.
CHUNK_BITS = 16
CHUNK = ("file", "block", "chunk")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """value, file, block, chunk, at (place of the line in its file) and quotes of every line."""
    meta = F.col("_metadata")
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", meta["file_path"].alias("file"), meta["file_block_start"].alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    return lines.select(
        *CHUNK[:2],
        F.shiftright("line", CHUNK_BITS).alias("chunk"),
        F.struct("block", "line").alias("at"),
        (F.length("value") - F.length(F.translate("value", '"', ""))).alias("quotes"),
        "value",
    )


def _with_parity(lines: DataFrame) -> DataFrame:
    """``odd``: whether the quotes before a line, counted from the start of its chunk, are odd."""
    before = Window.partitionBy(*CHUNK).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    return lines.withColumn("odd", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)


def _chunk_starts(lines: DataFrame) -> DataFrame:
    """Of every chunk: whether it begins inside quotes, and where the last record that began before it begins."""
    chunks = _with_parity(lines).groupBy(*CHUNK).agg(
        (F.sum("quotes") % 2).alias("turns"),
        F.max(F.when(~F.col("odd"), F.col("at"))).alias("last_outside"),
        F.max(F.when(F.col("odd"), F.col("at"))).alias("last_inside"),
    )
    in_order = Window.partitionBy("file").orderBy("block", "chunk")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    known = chunks.withColumn("inside", F.coalesce(F.sum("turns").over(before), F.lit(0)) % 2 == 1)
    is_last = F.lead("chunk").over(in_order).isNull()
    left_open = is_last & (F.col("inside").cast("int") + F.col("turns") == 1)
    refused = F.raise_error(F.concat(F.lit("ends inside quotes: "), F.col("file"))).cast("boolean")
    begun = F.when(F.col("inside"), F.col("last_inside")).otherwise(F.col("last_outside"))
    return known.select(
        *CHUNK, F.when(left_open, refused).otherwise(F.col("inside")).alias("inside"),
        F.last(begun, ignorenulls=True).over(before).alias("carried"),
    )


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``record``: one row for each record of the CSV files of ``path``, with its line breaks, in no order.

    Lines end in a line feed, with or without a carriage return. A quote inside quotes is doubled. Empty lines
    between records are no records. A file that ends inside quotes stops the read. No task holds more than a
    chunk of lines, or the lines of one record; the table of chunks is sorted by file.
    """
    lines = _lines(spark, path)
    placed = _with_parity(lines.join(_chunk_starts(lines), list(CHUNK)))
    starts = F.col("odd") == F.col("inside")
    up_to = Window.partitionBy(*CHUNK).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    owned = placed.select(
        "file", "at", "value", "quotes", F.coalesce(F.max(F.when(starts, F.col("at"))).over(up_to), F.col("carried")).alias("begun"),
    )
    whole = (F.col("begun") == F.col("at")) & (F.col("quotes") % 2 == 0)
    joined = F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]))
    broken = owned.where(~whole).groupBy("file", "begun").agg(joined.alias("record"))
    records = owned.where(whole).select(F.col("value").alias("record")).unionByName(broken.select("record"))
    record = F.col("record")
    ended = F.when(record.endswith("\r"), F.expr("left(record, length(record) - 1)")).otherwise(record)
    return records.select(ended.alias("record")).where("record <> ''")
