"""Stored tables that take only rows whose key they do not hold yet.

Rows lie in hash buckets of their key, and every load adds its own files. An index has one row for each file, with its
key range, and a Bloom filter in blocks of 2^15 bits, one row for each block. The keys of a batch meet the files of
their bucket by range, then one block of each file's filter; only files that may hold one of them are opened for the
anti join. What decides is the join: the index can only name a file too many.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.session import prepare, scratch_path
from ledgerloom.sources.tables import path_exists

BLOCK_BITS = 1 << 15  # what a bitmap of Spark's bitmap functions holds
BITS_PER_KEY, PROBES = 12, 5
# Rows of a file, which bounds what a filter and an anti join read for one key.
MOST_ROWS = 1 << 20
FILES = "file string, bucket int, rows long, blocks int, least string, most string"
FILTERS = "file string, block int, bits binary"


class KeyedTable:
    """A folder of parquet files with a unique key.

    A load is seen once its index is complete, so one that breaks off leaves the table as it was. One load runs at a
    time. Rows with a NULL in the key have no key: they never conflict and are always taken, as in SQL.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str], schema: StructType, buckets: int = 16):
        self.spark = prepare(spark)
        self.root = root.rstrip("/")
        self.keys, self.schema, self.buckets = keys, schema, buckets

    def _has_key(self) -> Column:
        found = F.lit(True)
        for k in self.keys:
            found = found & F.col(k).isNotNull()
        return found

    def _bucket(self) -> Column:
        # Rows without a key spread over the buckets by all they hold.
        whole = F.xxhash64(*(F.col(c) for c in self.schema.names))
        return F.pmod(F.when(self._has_key(), F.xxhash64(*self.keys)).otherwise(whole), F.lit(self.buckets)).cast("int")

    def _sortable(self) -> Column:
        """The key as text whose order is used for nothing but ranges."""
        return F.array_join(F.array(*(F.col(k).cast("string") for k in self.keys)), "\x1f")

    def _block(self, blocks: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit("block"), *self.keys), blocks).cast("int")

    def _probes(self) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(n), *self.keys), F.lit(BLOCK_BITS)).cast("int") for n in range(PROBES)]

    def _index(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(f"{schema}, load_id string").parquet(f"{self.root}/{name}")

    def loads(self) -> DataFrame:
        """load_id, load_no (1, 2, ...) and rows of every finished load."""
        if not path_exists(self.spark, f"{self.root}/loads"):
            return self.spark.createDataFrame([], "load_id string, load_no int, rows long")
        return self.spark.read.schema("load_id string, load_no int, rows long").json(f"{self.root}/loads")

    def _finished(self) -> list[tuple[str, int, int]]:
        return sorted((r["load_id"], r["load_no"], r["rows"]) for r in self.loads().collect())

    def read(self) -> DataFrame:
        """All rows, with the number of the load that brought them (load_no)."""
        done = self._finished()
        if not done:
            return self.spark.createDataFrame([], self.schema).withColumn("load_no", F.lit(None).cast("int"))
        paths = [f"{self.root}/data/load_id={load_id}" for load_id, _, _ in done]
        whole = StructType(list(self.schema.fields)).add("bucket", "integer").add("load_id", "string")
        rows = self.spark.read.schema(whole).option("basePath", f"{self.root}/data").parquet(*paths)
        return rows.join(self.loads().select("load_id", "load_no"), "load_id").select(*self.schema.names, "load_no")

    def candidate_files(self, batch: DataFrame) -> list[str]:
        """Stored files that may hold a key of ``batch``."""
        done = [load_id for load_id, _, _ in self._finished()]
        if not done:
            return []
        files = self._index("files", FILES).filter(F.col("load_id").isin(done)).drop("load_id")
        blocks = self._index("filters", FILTERS).filter(F.col("load_id").isin(done)).drop("load_id")
        sought = batch.filter(self._has_key()).select(
            self._bucket().alias("of_bucket"), self._sortable().alias("key"), *self.keys
        )
        met = sought.join(files, (F.col("of_bucket") == F.col("bucket")) & F.col("key").between(F.col("least"), F.col("most")))
        probes = met.select("file", self._block(F.col("blocks")).alias("block"), F.array(*self._probes()).alias("probes")).distinct()

        def is_set(probe: Column) -> Column:
            byte = F.conv(F.hex(F.substring("bits", F.floor(probe / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            return F.floor(byte / F.pow(F.lit(2), probe % 8)) % 2 == 1

        hits = probes.join(blocks, ["file", "block"]).filter(F.forall("probes", is_set))
        # Names of files, which the driver lists for every read anyway.
        return sorted(r["file"] for r in hits.select("file").distinct().collect())

    def absent(self, batch: DataFrame) -> DataFrame:
        """The rows of ``batch`` whose key is not stored."""
        files = self.candidate_files(batch)
        if not files:
            return batch
        stored = self.spark.read.schema(self.schema).parquet(*files).select(*self.keys)
        return batch.join(stored, self.keys, "left_anti").select(*self.schema.names)

    def insert_absent(self, rows: DataFrame, order: list[str] | None = None) -> int:
        """Add the rows whose key is not stored, one of each key, and return how many.

        Of several rows with one key the first by ``order`` counts; without it they must be equal. A batch that brings
        nothing new writes nothing that is seen.
        """
        spark, load_id = self.spark, f"l{uuid.uuid4().hex}"
        first = Window.partitionBy(*self.keys).orderBy(*(order or self.keys))
        keyed = rows.select(*self.schema.names)
        once = keyed.filter(self._has_key()).withColumn("row_no", F.row_number().over(first)).filter(F.col("row_no") == 1)
        once = once.drop("row_no").unionByName(keyed.filter(~self._has_key()))
        # Stored, so that looking up and adding see the same rows.
        path = scratch_path(spark, "batch")
        once.write.parquet(path)
        fresh = self.absent(spark.read.schema(self.schema).parquet(path))
        bucketed = fresh.withColumn("bucket", self._bucket())
        data = f"{self.root}/data/load_id={load_id}"
        spread = bucketed.repartition("bucket").sortWithinPartitions("bucket", *self.keys)
        spread.write.option("maxRecordsPerFile", MOST_ROWS).partitionBy("bucket").parquet(data)
        added = self._write_index(load_id, data)
        if added:
            number = 1 + max((n for _, n, _ in self._finished()), default=0)
            done = spark.createDataFrame([(load_id, number, added)], "load_id string, load_no int, rows long")
            done.coalesce(1).write.mode("append").json(f"{self.root}/loads")
        return added

    def _write_index(self, load_id: str, data: str) -> int:
        """Index the files of a load from their key columns; gives the rows."""
        spark = self.spark
        whole = StructType(list(self.schema.fields)).add("bucket", "integer")
        kept = spark.read.schema(whole).parquet(data).withColumn("file", F.input_file_name())
        needed = F.ceil(F.count_if(self._has_key()) * BITS_PER_KEY / BLOCK_BITS)
        files = kept.groupBy("file", "bucket").agg(
            F.count(F.lit(1)).alias("rows"),
            F.greatest(F.lit(1), needed).cast("int").alias("blocks"),
            F.min(F.when(self._has_key(), self._sortable())).alias("least"),
            F.max(F.when(self._has_key(), self._sortable())).alias("most"),
        )
        place = f"{self.root}/files/load_id={load_id}"
        files.write.parquet(place)
        made = spark.read.schema(FILES).parquet(place)
        total = made.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        if total:
            sized = kept.filter(self._has_key()).join(made.select(F.col("file").alias("of_file"), "blocks"), F.col("file") == F.col("of_file"))
            probes = sized.select("file", self._block(F.col("blocks")).alias("block"), F.explode(F.array(*self._probes())).alias("probe"))
            filters = probes.groupBy("file", "block").agg(F.bitmap_construct_agg("probe").alias("bits"))
            filters.write.parquet(f"{self.root}/filters/load_id={load_id}")
        return total
