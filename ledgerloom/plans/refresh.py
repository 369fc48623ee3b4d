"""Tables in parts, of which only those are rebuilt whose source rows changed.

A part's digest is the count and two sums of hashes of its source rows, which is the same in any order, so one pass
that shrinks to a row per part in the map tasks tells what changed. Only rows of changed parts go through the build,
and only their folders are replaced. Parts as small as a day of the mart share folders, and those that did not change
are carried over within them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.operators import financials, mrr
from ledgerloom.session import prepare, scratch_path
from ledgerloom.sources.tables import path_exists, remove_path

Build = Callable[[DataFrame], DataFrame]
# Brands are rebuilt together in so many groups.
BRAND_GROUPS = 64


def part_digests(source: DataFrame, part: str) -> DataFrame:
    """part, rows and two sums of hashes of every part of ``source``."""
    columns = sorted(source.columns)

    def digest(seed: int) -> Column:
        # A hash of a NULL leaves the seed as it was; the marks tell which columns are NULL.
        marks = [F.col(c).isNull() for c in columns]
        return F.sum(F.xxhash64(F.lit(seed), *columns, *marks).cast("decimal(20,0)")).cast("decimal(38,0)")

    return source.groupBy(part).agg(F.count(F.lit(1)).alias("rows"), digest(1).alias("digest_a"), digest(2).alias("digest_b"))


class PartTable:
    """A stored table whose rows belong to parts, with one folder for all parts of one ``folder_of``.

    The digests of a refresh are filed after its folders are replaced. A refresh that breaks off is made up by the
    next, which finds the same parts changed. One refresh runs at a time. Rows without a value of ``part`` are a part.
    """

    def __init__(self, spark: SparkSession, root: str, part: str, schema: StructType, folder_of: Callable[[Column], Column]):
        self.spark, self.root, self.part, self.schema = prepare(spark), root.rstrip("/"), part, schema
        self.folder_of = folder_of

    def _last(self) -> int:
        """Number of the last finished refresh; 0 before the first."""
        if not path_exists(self.spark, f"{self.root}/refreshes"):
            return 0
        done = self.spark.read.schema("refresh_no int").json(f"{self.root}/refreshes")
        return done.agg(F.coalesce(F.max("refresh_no"), F.lit(0))).first()[0]

    def _stored(self) -> DataFrame:
        """The rows with their folder."""
        path, whole = f"{self.root}/table", StructType(list(self.schema)).add("folder", "string")
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], whole)
        return self.spark.read.schema(whole).parquet(path)

    def read(self) -> DataFrame:
        return self._stored().select(*self.schema.names)

    def refresh(self, source: DataFrame, build: Build) -> DataFrame:
        """Bring the table up to date with ``source``, which has the column ``part``, and return the touched parts.

        ``build`` makes rows of the table from all source rows of some parts; every part must depend on its own rows
        alone. The result has the part and its change: new, changed or gone.
        """
        spark, part, last = self.spark, self.part, self._last()
        path = f"{self.root}/digests/refresh_no={last + 1}"
        part_digests(source, part).write.mode("overwrite").parquet(path)
        now = spark.read.parquet(path)
        before = spark.read.schema(now.schema).parquet(f"{self.root}/digests/refresh_no={last}") if last else now.limit(0)
        old = before.select(F.col(part).alias("old_part"), *(F.col(c).alias(f"old_{c}") for c in ("rows", "digest_a", "digest_b")))
        both = now.join(old, F.col(part).eqNullSafe(F.col("old_part")), "full")
        same = F.lit(True)
        for c in ("rows", "digest_a", "digest_b"):
            same = same & F.col(c).eqNullSafe(F.col(f"old_{c}"))
        change = F.when(F.col("old_rows").isNull(), "new").when(F.col("rows").isNull(), "gone").otherwise("changed")
        found = both.filter(~same).select(F.when(F.col("rows").isNull(), F.col("old_part")).otherwise(F.col(part)).alias(part), change.alias("change"))
        touched_path = scratch_path(spark, "touched")
        found.write.parquet(touched_path)
        touched = spark.read.schema(found.schema).parquet(touched_path)
        if not touched.isEmpty():
            self._replace(source, build, touched)
        spark.createDataFrame([(last + 1,)], "refresh_no int").coalesce(1).write.mode("append").json(f"{self.root}/refreshes")
        return touched

    def _replace(self, source: DataFrame, build: Build, touched: DataFrame) -> None:
        spark, part = self.spark, self.part
        folder = F.coalesce(self.folder_of(F.col(part)).cast("string"), F.lit("none"))
        asked = touched.select(F.col(part).alias("touched_part"), folder.alias("touched_folder"), "change")
        is_touched = F.col(part).eqNullSafe(F.col("touched_part"))
        rows = source.join(asked.filter(F.col("change") != "gone"), is_touched, "left_semi")
        # Other parts of the same folders are carried over as they are.
        beside = self._stored().join(asked.select("touched_folder").distinct(), F.col("folder") == F.col("touched_folder"), "left_semi")
        kept = beside.join(asked, is_touched, "left_anti")
        # Stored apart first: a build that fails leaves the table alone, and folders that came out empty show.
        path = scratch_path(spark, "rebuilt")
        build(rows).select(*self.schema.names).withColumn("folder", folder).unionByName(kept).write.parquet(path)
        rebuilt = spark.read.schema(kept.schema).parquet(path)
        # Rows of a folder lie together, so it has few files.
        rebuilt.repartition("folder").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("folder").parquet(
            f"{self.root}/table"
        )
        filled = rebuilt.select(F.col("folder").alias("filled")).distinct()
        empty = asked.select("touched_folder").distinct().join(filled, F.col("touched_folder") == F.col("filled"), "left_anti")
        for row in empty.collect():  # names of folders that lost all their rows
            remove_path(spark, f"{self.root}/table/folder={row[0]}")


def daily_table(spark: SparkSession, root: str, schema: StructType) -> PartTable:
    """A daily mart in folders of months."""
    return PartTable(spark, root, "entry_date", schema, lambda day: F.date_format(day, "yyyy-MM"))


def waterfall_table(spark: SparkSession, root: str, schema: StructType) -> PartTable:
    """A waterfall in folders of brand groups."""
    return PartTable(spark, root, "brand_group", StructType(list(schema)).add("brand_group", "integer"), lambda group: group)


def refresh_daily(table: PartTable, entries: DataFrame) -> DataFrame:
    """Rebuild the days of the daily mart whose ledger entries changed."""
    return table.refresh(entries, financials.daily_financials)


def refresh_waterfall(table: PartTable, subscriptions: DataFrame, calendar: DataFrame) -> DataFrame:
    """Rebuild the brand groups of the waterfall whose subscriptions changed; all, if the months of the spine did."""
    bounds = mrr.spine_bounds(subscriptions, calendar)
    # The months belong to what a group is made of.
    source = subscriptions.withColumns(
        {
            "brand_group": brand_group(F.col("brand_id")),
            "first_month": bounds.select("first_month").scalar(),
            "last_month": bounds.select("last_month").scalar(),
        }
    )

    def build(rows: DataFrame) -> DataFrame:
        spans = rows.drop("brand_group", "first_month", "last_month")
        return mrr.waterfall_between(spans, bounds).withColumn("brand_group", brand_group(F.col("brand_id")))

    return table.refresh(source, build)


def brand_group(brand_id: Column) -> Column:
    return F.pmod(brand_id, F.lit(BRAND_GROUPS)).cast("int")
