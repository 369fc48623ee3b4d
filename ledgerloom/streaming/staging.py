"""Subscription staging from a stream that delivers rows more than once and late.

Spark's state store remembers the event ids of the last ``delay`` of event time, so a row delivered again is dropped
without looking at what is stored, and the state stays as large as that stretch of time, however long the stream
runs. Rows older than the watermark, which the store would have to forget, go to a side table: nothing is lost. Every
batch is added by key, so a batch that is run again after a failure changes nothing. What is stored then goes through
the operators of the batch build.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerloom.operators import quarantine, subscriptions
from ledgerloom.session import prepare
from ledgerloom.sources.keyed import KeyedTable
from ledgerloom.sources.schemas import RAW_SUBSCRIPTION_EVENTS
from ledgerloom.sources.tables import path_exists

# A row of the stream by its own id; copies of an event have one raw_event_id and are settled by the batch rule.
ROW_KEY = "event_id"


def _accepted(spark: SparkSession, out: str) -> KeyedTable:
    return KeyedTable(spark, f"{out.rstrip('/')}/accepted", [ROW_KEY], StructType.fromDDL(RAW_SUBSCRIPTION_EVENTS))


def start_staging(events: DataFrame, out: str, checkpoint: str, delay: str = "7 days") -> StreamingQuery:
    """Take in all rows that have arrived; every row once in ``out/accepted``, or in ``out/late`` if it came too late.

    ``events`` is a stream of raw subscription events. Rows without a time pass by the state store, which could not
    tell when to forget them.
    """
    spark = prepare(events.sparkSession)
    timed = events.filter(F.col("event_at").isNotNull())
    first = timed.withWatermark("event_at", delay).dropDuplicatesWithinWatermark([ROW_KEY])
    # The rows as they arrived stand beside what the store let through, in the same batch of the same source.
    marked = first.withColumn("is_first", F.lit(True)).unionByName(events.withColumn("is_first", F.lit(False)))

    def take_in(batch: DataFrame, batch_id: int) -> None:
        path = f"{out.rstrip('/')}/arrived/batch_id={batch_id}"
        batch.write.mode("overwrite").partitionBy("is_first").parquet(path)
        arrived = spark.read.schema(batch.schema).parquet(path)
        rows = arrived.filter(~F.col("is_first")).drop("is_first")
        passed = arrived.filter("is_first").drop("is_first").unionByName(rows.filter(F.col("event_at").isNull()))
        accepted = _accepted(spark, out)
        accepted.insert_absent(passed, accepted.schema.names)
        # Dropped by the store, and not because the row is known.
        late = accepted.absent(rows).dropDuplicates([ROW_KEY])
        late.write.mode("overwrite").parquet(f"{out.rstrip('/')}/late/batch_id={batch_id}")

    return (
        marked.writeStream.foreachBatch(take_in)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def late_events(spark: SparkSession, out: str) -> DataFrame:
    """Rows that came after the watermark had passed them, one of each id."""
    path = f"{out.rstrip('/')}/late"
    if not path_exists(spark, path):
        return spark.createDataFrame([], RAW_SUBSCRIPTION_EVENTS)
    return spark.read.schema(RAW_SUBSCRIPTION_EVENTS).parquet(path).drop("batch_id").dropDuplicates([ROW_KEY])


def taken_in(spark: SparkSession, out: str, with_late: bool = True) -> DataFrame:
    """All rows of the stream, each once; with or without those that came late."""
    rows = _accepted(spark, out).read().drop("load_no")
    return rows.unionByName(late_events(spark, out)) if with_late else rows


def staged_subscriptions(spark: SparkSession, out: str, brands: DataFrame, as_of: dt.datetime, with_late: bool = True) -> DataFrame:
    """Subscription spans of what the stream has brought so far."""
    return subscriptions.stage_subscriptions(subscriptions.resolved_events(taken_in(spark, out, with_late), brands, as_of))


def unmatched(spark: SparkSession, out: str, brands: DataFrame, with_late: bool = True) -> DataFrame:
    """Quarantined rows of what the stream has brought so far."""
    return quarantine.unmatched_events(taken_in(spark, out, with_late), brands)
