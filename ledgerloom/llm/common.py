"""What the operators share: shipped code, cut lineage, bounded samples, folds."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import prepare, scratch_path

# Word separators of the contracts: space, tab, newline, vertical tab, form feed, return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def ship(*modules: str) -> None:
    """Send these modules' code along with the tasks, so that executors need no copy of the library."""
    for name in modules:
        cloudpickle.register_pickle_by_value(sys.modules[name])


def settle(spark: SparkSession) -> SparkSession:
    """Session settings that operators rely on, and a checkpoint folder all executors can reach."""
    prepare(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_path(spark, "cut"))
    return spark


def cut(df: DataFrame) -> DataFrame:
    """Store ``df`` in the shared checkpoint folder; later reads neither recompute it nor need its executors."""
    settle(df.sparkSession)
    return df.checkpoint(eager=True)


def free_name(columns: list[str], stem: str) -> str:
    """``stem``, lengthened until no column has that name in any letter case."""
    taken = {c.lower() for c in columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def held_out(doc_id: Column) -> Column:
    """True for the documents that no model may learn from; false for a NULL id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def bounded_sample(rows: DataFrame, key: str, label: str, per_label: int) -> DataFrame:
    """About ``per_label`` rows of each label, at most twice that, chosen by a hash of ``key``.

    Only ``key`` and ``label`` are read for the counts. A label with fewer rows keeps all of them. The same
    rows are chosen in every run. NULL keys and labels are left out.
    """
    rows = rows.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    if not counts:
        return rows.limit(0)
    buckets = 1 << 30
    keep = F.lit(False)
    for value, n in sorted(counts.items(), key=lambda x: str(x[0])):
        bound = min(buckets, -(-buckets * per_label // n))
        keep = keep | ((F.col(label) == F.lit(value)) & (F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(buckets)) < bound))
    return rows.filter(keep).limit(2 * per_label * len(counts))
