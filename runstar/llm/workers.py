"""Python code for the executors' workers."""

from __future__ import annotations

import ctypes
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
#: Bytes of a batch. It is held by the executor and by the worker at the same time.
BATCH = "16m"


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors, once an application: they need not have it installed."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        to = Path(tempfile.mkdtemp(prefix="runstar-")) / f"{package.name}-{context.applicationId}"
        context.addPyFile(shutil.make_archive(str(to), "zip", package.parent, package.name))
        _shipped.add(context.applicationId)


def _tidy(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``task`` that hands freed memory back at its end: a worker that waits for its next task keeps none of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
        if trim:
            trim(0)
    return run


def map_arrow(rows: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``rows.mapInArrow`` with this package at hand, in batches that leave room beside a worker's own arrays."""
    ship(rows.sparkSession)
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)
    return rows.mapInArrow(_tidy(task), schema)
