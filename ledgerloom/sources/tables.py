"""Result tables: written per run, shown once they passed."""

from __future__ import annotations

import datetime as dt
import uuid

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any file system that Spark reads."""
    place, system = _place(spark, path)
    return system.exists(place)


def folders_in(spark: SparkSession, path: str) -> list[tuple[str, str, dt.datetime]]:
    """Name, path and time of change of the folders right below ``path``; none if it is not there."""
    place, system = _place(spark, path)
    if not system.exists(place):
        return []
    found = [s for s in system.listStatus(place) if s.isDirectory()]
    return [
        (s.getPath().getName(), s.getPath().toString(), dt.datetime.fromtimestamp(s.getModificationTime() / 1000, dt.timezone.utc))
        for s in found
    ]


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of this library's own tables, if it is there."""
    place, system = _place(spark, path)
    system.delete(place, True)


class RunFolder:
    """The tables of one build, each written once and read back.

    Writing cuts the lineage, and the files outlive any executor. The root must
    be a folder that all executors share. A table's runs lie side by side in its
    folder, so that one name of a run selects the files of all tables.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        # The letter keeps Spark from taking an id of digits for a number.
        self.run_id = f"r{uuid.uuid4().hex}"
        self.tables: dict[str, DataFrame] = {}
        self.figures: dict[str, dict[str, object]] = {}
        self.checked = False

    def location(self, name: str) -> str:
        return f"{self.root}/{name}/run_id={self.run_id}"

    def keep(self, name: str, df: DataFrame, figures: Mapping[str, Column] | None = None) -> DataFrame:
        """Write a table and return it as read from its files.

        ``figures`` are aggregates over its rows, gathered in the pass that writes them; see ``self.figures``.
        """
        schema, seen = df.schema, None
        if figures:
            seen = Observation()
            df = df.observe(seen, *(value.alias(key) for key, value in figures.items()))
        df.write.mode("errorifexists").parquet(self.location(name))
        if seen is not None:
            self.figures[name] = dict(seen.get)
        self.tables[name] = self.spark.read.schema(schema).parquet(self.location(name))
        return self.tables[name]

    def publish(self, database: str, names: list[str] | None = None) -> None:
        """Show this run in the public views, all of them at once.

        The views read the run that the view ``current_run`` names. Replacing
        that one view is a single catalog step, so a reader sees all tables of
        the old run or all of the new one, wherever a publish breaks off. The
        views themselves are made once and stay as they are.
        """
        if not self.checked:
            raise RuntimeError("only a run whose checks passed can be published")
        sql = self.spark.sql
        sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        current = f"{database}.current_run"
        first = not self.spark.catalog.tableExists(current)
        if first:
            self._point(current)
        for name in names or list(self.tables):
            columns = ", ".join(f"`{c}`" for c in self.tables[name].columns)
            sql(
                f"CREATE VIEW IF NOT EXISTS {database}.{name} AS SELECT {columns} FROM parquet.`{self.root}/{name}` "
                f"WHERE run_id = (SELECT run_id FROM {current})"
            )
        if not first:
            self._point(current)

    def _point(self, current: str) -> None:
        self.spark.sql(f"CREATE OR REPLACE VIEW {current} AS SELECT '{self.run_id}' AS run_id")
