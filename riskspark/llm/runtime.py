"""What a session needs before the operators run on it."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

from riskspark.session import ship_package

_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Rows that a writer gathers before it starts a new group take this many bytes.
_ROW_GROUP = ("parquet.block.size", str(16 << 20))


def prepare(spark: SparkSession, batch: str = "16m") -> None:
    """Ship the package, and keep what Python tasks get at once to ``batch`` bytes or one row."""
    ship_package(spark)
    spark.conf.set(_BATCH, batch)
    spark.conf.set(*_ROW_GROUP)


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The task function ``run``, giving free memory back to the system when a task ends.

    Workers are reused, so what their allocators keep would add up over the stages of a job.
    """

    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # another C library
                pass

    return task
