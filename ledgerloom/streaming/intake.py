"""Continuous intake of raw subscription events.

Each micro-batch is written once per batch id, so a replayed batch replaces
itself. Copies inside a batch are dropped on the way in; copies across batches
and late events stay, and :func:`accepted_events` settles them with the batch
rule. Nothing is lost to a watermark and no state grows with the stream.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators import quarantine
from ledgerloom.operators.subscriptions import dedup_events
from ledgerloom.session import prepare
from ledgerloom.sources.schemas import RAW_SUBSCRIPTION_EVENTS


def event_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """New parquet files of raw events as they arrive."""
    return (
        spark.readStream.schema(RAW_SUBSCRIPTION_EVENTS)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def start_intake(events: DataFrame, brands: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Sort arriving events into ``out/accepted`` and ``out/unmatched`` and stop when none are left."""
    prepare(events.sparkSession)
    known = brands.select("brand_external_id")

    def sort_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.DISK_ONLY)  # both writes read the source once; a lost part is read again
        accepted = dedup_events(batch).join(known, "brand_external_id", "left_semi")
        unmatched = quarantine.unmatched_events(batch, brands)
        accepted.write.mode("overwrite").parquet(f"{out}/accepted/batch_id={batch_id}")
        unmatched.write.mode("overwrite").parquet(f"{out}/unmatched/batch_id={batch_id}")
        batch.unpersist()

    return (
        events.writeStream.foreachBatch(sort_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def accepted_events(spark: SparkSession, out: str) -> DataFrame:
    """Accepted events of all batches, one row per raw event id."""
    return dedup_events(spark.read.parquet(f"{out}/accepted").drop("batch_id"))


def unmatched_events(spark: SparkSession, out: str) -> DataFrame:
    """Quarantined events of all batches."""
    return spark.read.parquet(f"{out}/unmatched").drop("batch_id")
