"""Submitting independent Spark jobs together, and what their tasks need."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor, as_completed, wait
from pathlib import Path
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")


def let_workers_import(spark: SparkSession) -> None:
    """Tell Python workers started from now on where this package lies, as tasks import it."""
    root, environment = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def side_by_side(
    spark: SparkSession, threads: int, jobs: Mapping[str, Callable[[], T]]
) -> dict[str, T]:
    """Run jobs from several threads, so that the short last stages of one leave no core idle.

    Returns their results by name. When one fails, the others are cancelled, and what the first
    one to fail raised is raised once all have ended.
    """
    context, tag = spark.sparkContext, f"side-by-side-{uuid.uuid4().hex}"

    def tagged(job: Callable[[], T]) -> Callable[[], T]:
        def run() -> T:
            context.addJobTag(tag)
            try:
                return job()
            finally:
                context.removeJobTag(tag)

        return run

    with ThreadPoolExecutor(threads) as pool:
        running = {
            name: pool.submit(inheritable_thread_target(spark)(tagged(job)))
            for name, job in jobs.items()
        }
        for ended in as_completed(running.values()):
            if ended.exception() is None:
                continue
            for other in running.values():
                other.cancel()
            # A job cut off between two Spark jobs may start another one: cancel until all ended.
            while wait(running.values(), timeout=0.2).not_done:
                context.cancelJobsWithTag(tag)
            raise ended.exception()
        return {name: job.result() for name, job in running.items()}
