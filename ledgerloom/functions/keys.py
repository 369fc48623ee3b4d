"""Identifiers derived from content, and dense numbering without a global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def subscription_id(brand_id: Column, plan_name: Column, start_date: Column) -> Column:
    """SHA-256 hex of brand, plan and start date; NULL if one of them is."""
    bar = F.lit("|")
    text = F.concat(brand_id.cast("string"), bar, plan_name, bar, start_date.cast("string"))
    return F.sha2(text, 256)


def event_fingerprint(owner: Column, event_type: Column, at_text: Column, seq: Column) -> Column:
    """First 32 hex characters of the SHA-256 of ``owner:type:time:seq``."""
    return F.substring(F.sha2(F.concat_ws(":", owner, event_type, at_text, seq.cast("string")), 256), 1, 32)


def with_dense_key(df: DataFrame, unique_col: str, name: str, hex_digits: int = 3) -> DataFrame:
    """Number the rows 1..n by a unique column.

    Rows are numbered inside hash buckets of near-equal size and shifted by the
    rows of the buckets before, so no task sees more than one bucket and a
    re-run task gives the same numbers. There are at most 16**hex_digits
    buckets, which bounds the broadcast table of offsets.
    """
    tagged = df.withColumn("_bucket", F.substring(F.md5(F.col(unique_col).cast("string")), 1, hex_digits))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_bucket").orderBy(unique_col)
    return (
        tagged.withColumn("_position", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(name, F.col("_offset") + F.col("_position"))
        .drop("_bucket", "_offset", "_position")
    )


def with_group_sequence(
    df: DataFrame, group: str, id_col: str, name: str, low_bits: int = 20, high_bits: int = 42
) -> DataFrame:
    """Number rows 1..n inside each group in order of a unique 64-bit id.

    A group may hold a large part of the table, so it is never sorted whole. It
    is cut into id ranges of 2**low_bits, which hold at most that many rows
    because ids are unique, and every range starts after the rows of the ranges
    before it. Ranges are counted inside blocks of 2**high_bits ids, so no
    window sees more than 2**22 of them, however sparse the ids are.
    ``group`` must not be NULL.
    """
    cut = df.withColumns(
        {"_low": F.shiftright(id_col, low_bits), "_high": F.shiftright(id_col, high_bits)}
    )

    def before(*keys: str, order: str) -> WindowSpec:
        return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    def rows_before(window: WindowSpec) -> Column:
        return F.coalesce(F.sum("_rows").over(window), F.lit(0))

    ranges = cut.groupBy(group, "_high", "_low").agg(F.count(F.lit(1)).alias("_rows"))
    blocks = ranges.groupBy(group, "_high").agg(F.sum("_rows").alias("_rows"))
    starts = (
        ranges.select(group, "_high", "_low", rows_before(before(group, "_high", order="_low")).alias("_inside"))
        .join(blocks.select(group, "_high", rows_before(before(group, order="_high")).alias("_outside")), [group, "_high"])
        .select(group, "_low", (F.col("_inside") + F.col("_outside")).alias("_offset"))
    )
    inside = Window.partitionBy(group, "_low").orderBy(id_col)
    return (
        cut.withColumn("_position", F.row_number().over(inside))
        .join(starts, [group, "_low"])
        .withColumn(name, F.col("_offset") + F.col("_position"))
        .drop("_low", "_high", "_offset", "_position")
    )


# Equal rows that are numbered in one array at most.
RUN_ROWS = 10_000


def with_row_key(df: DataFrame, name: str) -> DataFrame:
    """Add a key of every row: 32 hex characters of the SHA-256 of its values and of its number among equal rows.

    Equal rows shrink to one with a count in the map tasks and are spread out again, so a row with very many copies is
    no hot key, and the same rows get the same keys in every run, however they are dealt. The key of a row does not
    depend on other rows than its copies. Key columns must be of types that have a text form.
    """
    columns = df.columns
    counted = df.groupBy(*(f"`{c}`" for c in columns)).agg(F.count(F.lit(1)).alias("_rows"))
    runs = F.sequence(F.lit(0).cast("long"), F.expr(f"(_rows - 1) div {RUN_ROWS}"))
    inside = F.least(F.lit(RUN_ROWS).cast("long"), F.col("_rows") - F.col("_run") * RUN_ROWS)
    spread = (
        counted.withColumn("_run", F.explode(runs))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), inside)))
        .withColumn("_copy", F.col("_run") * RUN_ROWS + F.col("_copy"))
    )
    # A value and its length: no two rows have one text.
    values = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x00")) for c in columns]
    text = F.concat_ws("|", *(part for v in values for part in (F.length(v).cast("string"), v)), F.col("_copy").cast("string"))
    return spread.select(*(f"`{c}`" for c in columns), F.substring(F.sha2(text, 256), 1, 32).alias(name))
