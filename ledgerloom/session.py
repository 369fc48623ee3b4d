"""Session settings the operators rely on."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings only. The number of shuffle partitions, executor memory and
# split sizes belong to the cluster; adaptive execution coalesces and splits.
REQUIRED = {
    # Dates are taken from timestamps in the session zone.
    "spark.sql.session.timeZone": "UTC",
    # Hot join keys are split at run time, small join sides found at run time
    # are broadcast, both by measured size.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Also where the next step could have used the join's partitioning: another
    # shuffle is cheaper than one task with a third of the rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Set on ``spark`` what right results and split hot keys need."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, app: str = "ledgerloom", memory: str = "8g") -> SparkSession:
    """One-JVM session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        # Small test data still spreads over the cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        # Branches of a build share the cores.
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in REQUIRED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@functools.cache
def _local_root(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="run-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for data written once and read back.

    The folder lies under ``spark.checkpoint.dir``, which every executor of a
    cluster can reach. Only a local session may go without that setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = _local_root(spark.sparkContext.applicationId)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
