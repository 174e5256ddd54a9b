"""What the operators ask of the caller's session."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import SparkSession


# Of text that goes to or comes from a Python worker at a time. Texts differ by orders of
# magnitude in length, so a number of rows is no bound.
ARROW_BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, and tell Python workers started from now on where this
    package lies, as they import it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def releasing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; behind the last one, Arrow's unused memory goes back to the system, as the
    worker stays for other tasks."""
    yield from batches
    pa.default_memory_pool().release_unused()


_held: dict[str, Callable[[], None]] = {}


def hold_alone(owner: str, release: Callable[[], None]) -> None:
    """Inside a task: the worker is to keep caches of ``owner`` between tasks, which ``release``
    frees. What it kept for other operators goes, as one worker serves many jobs."""
    for other in [name for name in _held if name != owner]:
        _held.pop(other)()
    _held[owner] = release
