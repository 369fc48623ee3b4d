"""Fact tables stored in buckets of a shared key, so that joining them again needs no shuffle.

Every key lies in one bucket, and a bucket is read by one task. Keys with very many rows would make one bucket as long
as they are, so their rows are kept apart in a plain table, which joins by shuffle and is split where it is skewed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of a key above which it is kept apart.
HOT_ROWS = 1_000_000


@dataclass(frozen=True)
class Colocated:
    """A stored table: ``name`` in buckets, ``name_apart`` with the rows of hot keys and those without a key."""

    spark: SparkSession
    name: str

    @property
    def bucketed(self) -> DataFrame:
        return self.spark.table(self.name)

    @property
    def apart(self) -> DataFrame:
        return self.spark.table(f"{self.name}_apart")

    def rows(self) -> DataFrame:
        """The whole table."""
        return self.bucketed.unionByName(self.apart)

    def forget(self) -> None:
        """Take both tables out of the catalog; their files are the owner's to remove."""
        for name in (self.name, f"{self.name}_apart"):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def hot_keys(tables: Mapping[str, DataFrame], key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows in any of the tables: at most a key for as many rows."""
    hot = None
    for df in tables.values():
        counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        found = counts.where(F.col("n") > hot_rows).select(key)
        hot = found if hot is None else hot.unionByName(found)
    return hot.distinct()


def store(
    spark: SparkSession, tables: Mapping[str, DataFrame], folder: str, key: str, buckets: int, hot_rows: int = HOT_ROWS
) -> dict[str, Colocated]:
    """Store tables (catalog name to rows) in equal buckets of ``key``, one sorted file each.

    A key that is hot in one of them is kept apart in all, so equal keys always meet in the same part. The hot keys
    are written first: all tables are divided by the same ones, and a task that is run again too. Give all tables that
    are joined later in one call; an existing table of a name is an error.
    """
    hot_keys(tables, key, hot_rows).write.parquet(f"{folder}/hot_keys")
    hot = spark.read.parquet(f"{folder}/hot_keys").withColumnRenamed(key, "_hot_key")
    for name, df in tables.items():
        usual = df.where(F.col(key).isNotNull()).join(hot, F.col(key) == F.col("_hot_key"), "left_anti")
        rare = df.where(F.col(key).isNotNull()).join(hot, F.col(key) == F.col("_hot_key"), "left_semi")
        rare = rare.unionByName(df.where(F.col(key).isNull()))
        written = usual.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        written.format("parquet").option("path", f"{folder}/{name}").saveAsTable(name)
        rare.write.format("parquet").option("path", f"{folder}/{name}_apart").saveAsTable(f"{name}_apart")
    return {name: Colocated(spark, name) for name in tables}


def together(left: Colocated, right: Colocated, joined: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """``joined(left, right)`` part by part, for a function that brings the tables together by their shared key.

    Inner, left and full joins and anti and semi joins on the key qualify, as equal keys lie in the same part.
    """
    return joined(left.bucketed, right.bucketed).unionByName(joined(left.apart, right.apart))
