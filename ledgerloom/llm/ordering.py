"""Places and neighbours in ordered groups of any size.

Rows are dealt to ranges of group and order, which Spark draws from a sample, so a group that holds much of the table
is spread over many ranges. Windows see one group inside one range; what reaches over ranges is carried by one row for
each group and range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, free_name


def _ranged(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with the number of their range, stored: a range is then the same for all that reads it."""
    return cut(rows.repartitionByRange(group, *order).withColumn(name, F.spark_partition_id()))


def numbered(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with their place (0, 1, ...) in the group by ``order``; rows that tie are numbered in some order."""
    part = free_name([*rows.columns, name], "range_no")
    ranged = _ranged(rows, group, order, part)
    before = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy(group, part)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.col(group).alias("of_group"), F.col(part).alias("of_part"), F.sum("rows").over(before).alias("start"))
        # Only groups that began in an earlier range: at most one for each range.
        .filter(F.col("start").isNotNull())
    )
    inside = F.row_number().over(Window.partitionBy(group, part).orderBy(*order)) - 1
    placed = ranged.withColumn(name, inside.cast("long"))
    joined = placed.join(starts, (F.col(group) == F.col("of_group")) & (F.col(part) == F.col("of_part")), "left")
    return joined.withColumn(name, F.col(name) + F.coalesce("start", F.lit(0))).drop(part, "of_group", "of_part", "start")


def with_following(rows: DataFrame, group: str, order: str, value: str, following: str, first: str) -> DataFrame:
    """``rows`` with the value of the next row of their group (NULL for the last) and whether they are the first of it."""
    part = free_name([*rows.columns, following, first], "range_no")
    ranged = _ranged(rows, group, [order], part)
    ends = ranged.groupBy(group, part).agg(F.min(order).alias("least"), F.min_by(value, order).alias("begins"))
    along = Window.partitionBy(group).orderBy(part)
    ends = ends.select(
        F.col(group).alias("of_group"),
        F.col(part).alias("of_part"),
        F.lead("begins").over(along).alias("next_begins"),
        F.lag("begins").over(along).isNull().alias("opens"),
    ).filter(F.col("next_begins").isNotNull() | ~F.col("opens"))
    inside = Window.partitionBy(group, part).orderBy(order)
    placed = ranged.withColumns({following: F.lead(value).over(inside), first: F.row_number().over(inside) == 1})
    joined = placed.join(ends, (F.col(group) == F.col("of_group")) & (F.col(part) == F.col("of_part")), "left")
    return joined.withColumns(
        {following: F.coalesce(following, "next_begins"), first: F.col(first) & F.coalesce("opens", F.lit(True))}
    ).drop(part, "of_group", "of_part", "next_begins", "opens")
