"""Several fits at a time, so that short jobs fill the cluster together."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")


def run_all(
    spark: SparkSession, tasks: Sequence[Callable[[], Result]], parallelism: int = 4
) -> list[Result]:
    """Results of the tasks, in order, with at most ``parallelism`` running at once."""
    with ThreadPool(min(parallelism, len(tasks))) as pool:
        return pool.map(inheritable_thread_target(spark)(lambda task: task()), tasks, chunksize=1)
