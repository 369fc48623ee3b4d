"""Branches of a build that do not need each other, side by side."""

from __future__ import annotations

import queue
import uuid
from collections.abc import Callable, Mapping
from typing import TypeVar

from pyspark import InheritableThread
from pyspark.sql import SparkSession

T = TypeVar("T")


def run_together(spark: SparkSession, branches: Mapping[str, Callable[[], T]]) -> dict[str, T]:
    """Run every branch in a thread of its own and return what each gave.

    A thread only submits jobs; the work is the executors'. Each branch has its job group and, where the cluster
    schedules fairly, its pool. The first error cancels the jobs of all other branches, and those they would still
    submit, and is raised when all threads have ended.
    """
    context = spark.sparkContext
    groups = {name: f"{name}-{uuid.uuid4().hex}" for name in branches}
    results: dict[str, T] = {}
    ended: queue.Queue[tuple[str, BaseException | None]] = queue.Queue()

    def run(name: str, branch: Callable[[], T]) -> None:
        try:
            context.setJobGroup(groups[name], name, interruptOnCancel=True)
            context.setLocalProperty("spark.scheduler.pool", name)
            results[name] = branch()
            ended.put((name, None))
        except BaseException as error:  # noqa: BLE001 - handed to the caller
            ended.put((name, error))

    threads = [InheritableThread(target=run, args=item, session=spark) for item in branches.items()]
    for thread in threads:
        thread.start()
    first_error, running = None, set(branches)
    while running:
        name, error = ended.get()
        running.discard(name)
        if error is not None and first_error is None:
            first_error = error
            for other in running:
                context._jsc.sc().cancelJobGroupAndFutureJobs(groups[other])
    for thread in threads:
        thread.join()
    if first_error is not None:
        raise first_error
    return results
