"""Sources mixed to target weights along a curriculum.

Each source has a share of the mix and a weight that changes over training time: it starts at 1 - tilt of its mean
and ends at 1 + tilt. The weight's integral is the source's cumulative token demand, and inverting it turns a
document's place in its source's stream of tokens into its time in training. Documents are range-sorted by that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import WORD_PATTERN, cut, settle

WEIGHTS = (1, 2, 3)
# How far the weight of a source with each of WEIGHTS moves to either side of its mean over training.
TILTS = (-0.5, 0.0, 0.5)
MOST_REPEATS = 3
# Hash buckets of a source, 16 to this power: running sums are made inside a bucket and over the buckets.
BUCKET_DIGITS = 3


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def place_of(doc_id: Column, text: Column) -> Column:
    """A document's place in its source's stream: by a hash of its id and text, the same in every run."""
    own = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), own).cast("binary"))


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, weight and target of every source of ``sizes`` (source, size).

    Shares of all words go by weight; a source gets at most three times its size, and what that leaves over goes to
    the others by weight again. That ends at one level at which every source gets its weight times the level or its
    most: among the levels that hold if the sources soonest full are full, the highest. Only the table of sources,
    one row each, is put in order in one task.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    kinds = F.array(*map(F.lit, WEIGHTS))
    weighed = totals.withColumn("weight", F.element_at(kinds, (F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1))
    by_fill = Window.orderBy(MOST_REPEATS * F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    fuller = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - MOST_REPEATS * F.coalesce(F.sum("source_size").over(fuller), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(fuller), F.lit(0))
    levels = weighed.withColumn("level", left / open_weight)
    level = F.max("level").over(everything)
    target = F.least(F.col("weight") * level, (MOST_REPEATS * F.col("source_size")).cast("double"))
    return levels.select("source", "source_size", "weight", target.alias("target"))


def plan(rows: DataFrame) -> DataFrame:
    """What the mix takes of every row of ``rows`` (doc_id, source, size, place and any others).

    Adds source_size, weight, target, words_before (words of the source's stream before the row), whole (how often
    the row is taken whole), rest (words that the last, partial pass through the stream takes) and part (those of them
    that are the row's). The stream of a source is passed through whole as often as its target holds its size.
    """
    keyed = rows.withColumn("bucket", F.substring("place", 1, BUCKET_DIGITS))
    targets = source_targets(rows.select("source", "size"))
    over = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        keyed.groupBy("source", "bucket")
        .agg(F.sum("size").alias("words"))
        .select(F.col("source").alias("of_source"), F.col("bucket").alias("of_bucket"), F.coalesce(F.sum("words").over(over), F.lit(0)).alias("start"))
    )
    settings = starts.join(targets, F.col("of_source").eqNullSafe(F.col("source"))).drop("source")
    inside = Window.partitionBy("source", "bucket").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(inside), F.lit(0))
    placed = keyed.withColumn("before_here", before).join(
        settings, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("bucket") == F.col("of_bucket"))
    )
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(MOST_REPEATS))).otherwise(F.lit(0))
    rest = F.when(F.col("whole") < MOST_REPEATS, F.round(F.col("target") - F.col("whole") * F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    return (
        placed.withColumn("words_before", F.col("start") + F.col("before_here"))
        .withColumn("whole", whole.cast("long"))
        .withColumn("rest", rest)
        .withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("words_before"))).cast("long"))
        .drop("bucket", "of_source", "of_bucket", "start", "before_here")
    )


def training_time(words_before: Column, target: Column, weight: Column) -> Column:
    """When training has asked a source for so many words: the inverse of its cumulative demand, 0 to 1."""
    share = F.least(F.lit(1.0), words_before / target)
    tilt = F.element_at(F.array(*map(F.lit, TILTS)), F.element_at(F.create_map(*(F.lit(x) for p in enumerate(WEIGHTS, 1) for x in p[::-1])), weight))
    # Demand at time t, as a share: t + tilt (t^2 - t).
    return 2 * share / ((1 - tilt) + F.sqrt((1 - tilt) * (1 - tilt) + 4 * tilt * share))


def mixture(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken and the time of the first take (position) of every row, in that order.

    NULL text has size 0; a NULL source is a source of its own. Sources without words have target 0. Repeated rows are
    documents of their own. Rows that are not taken come last, without position. Other columns are ignored.
    """
    settle(docs.sparkSession)
    place = place_of(F.col("doc_id"), F.col("text"))
    rows = cut(docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), place.alias("place")))
    planned = plan(rows)
    taken = F.col("whole") * F.col("size") + F.col("part")
    when = F.when((F.col("whole") > 0) | (F.col("part") > 0), training_time(F.col("words_before"), F.col("target"), F.col("weight")))
    return planned.select(
        "doc_id", "size", "source_size", "target", taken.alias("taken"), "source", F.when(F.col("target") > 0, when).alias("position")
    ).orderBy(F.col("position").asc_nulls_last(), "doc_id")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of the mix in training order, with the columns of ``docs`` as they are: a row for each take.

    Documents are taken whole. In the partial pass a document is taken if at least half of it lies before the target's
    last word, so a source's words come to its target within half a document. One without words is taken as often as
    its source is passed through whole. Columns of any names are carried along.
    """
    settle(docs.sparkSession)
    columns = docs.columns
    place = place_of(F.col("doc_id"), F.col("text"))
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row_"), "doc_id", "source", size_of(F.col("text")).alias("size"), place.alias("place")
    )
    half_before = (F.col("size") > 0) & (2 * F.col("words_before") + F.col("size") <= 2 * F.col("rest"))
    passes = F.col("whole") + half_before.cast("long")
    numbers = F.when(passes > 0, F.sequence(F.lit(0).cast("long"), passes - 1)).otherwise(F.array().cast("array<long>"))
    each = plan(rows).withColumn("pass_no", F.explode(numbers))
    begun = F.col("words_before") + F.col("pass_no") * F.col("source_size")
    position = F.when(F.col("target") > 0, training_time(begun, F.col("target"), F.col("weight"))).otherwise(F.lit(0.0))
    in_order = each.withColumn("position", position).orderBy("position", "place", "pass_no")
    return in_order.select(*(F.col(f"row_.`{c}`").alias(c) for c in columns))
