"""What earlier runs left behind, listed and removed when the owner asks.

Nothing is ever removed on its own. Only folders with the names that this library gives are listed or touched.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import SparkSession

from ledgerloom.sources.tables import folders_in, remove_path

_RUN = re.compile(r"run_id=(r?[0-9a-f]{32})")
_SCRATCH = re.compile(r"[A-Za-z_]+-[0-9a-f]{32}")


@dataclass(frozen=True)
class Leftover:
    """A run (its id) or a scratch folder (its name), where it lies, and when it was last written."""

    name: str
    paths: tuple[str, ...]
    modified: dt.datetime


def runs_in(spark: SparkSession, root: str) -> list[Leftover]:
    """The runs under a root of result tables, oldest first."""
    found: dict[str, list[tuple[str, dt.datetime]]] = {}
    for _, table, _ in folders_in(spark, root):
        for name, path, modified in folders_in(spark, table):
            if match := _RUN.fullmatch(name):
                found.setdefault(match[1], []).append((path, modified))
    made = [Leftover(run, tuple(sorted(p for p, _ in parts)), max(t for _, t in parts)) for run, parts in found.items()]
    return sorted(made, key=lambda run: (run.modified, run.name))


def remove_old_runs(spark: SparkSession, root: str, database: str, keep: int = 1) -> list[str]:
    """Remove all runs but the published one and the ``keep`` newest; returns the ids of those removed.

    A run that is being written is among the newest: keep at least as many as may be under way.
    """
    runs = runs_in(spark, root)
    current = f"{database}.current_run"
    published = {r["run_id"] for r in spark.table(current).collect()} if spark.catalog.tableExists(current) else set()
    kept = published | {run.name for run in runs[max(0, len(runs) - keep) :]}
    old = [run for run in runs if run.name not in kept]
    for run in old:
        for path in run.paths:
            remove_path(spark, path)
    return [run.name for run in old]


def scratch_in(spark: SparkSession, root: str) -> list[Leftover]:
    """Folders that queries wrote once and read back, under ``spark.checkpoint.dir`` or another root."""
    made = [Leftover(name, (path,), modified) for name, path, modified in folders_in(spark, root) if _SCRATCH.fullmatch(name)]
    return sorted(made, key=lambda folder: (folder.modified, folder.name))


def remove_old_scratch(spark: SparkSession, root: str, before: dt.datetime) -> list[str]:
    """Remove scratch folders last written before a time that no running query reaches back to; returns their names."""
    old = [folder for folder in scratch_in(spark, root) if folder.modified < before]
    for folder in old:
        remove_path(spark, folder.paths[0])
    return [folder.name for folder in old]
