"""What the corpus operators share: tables, texts and Arrow batches."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PIECE_CHARS = 2_000_000
BATCH_ROWS = 500
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within, tables that are written move to Python in Arrow batches of so many rows.

    Spark bounds a batch by rows alone, so long rows need fewer for the same memory.
    """
    before = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = PIECE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one slice hold about ``most`` bytes, or a single row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, held = 0, 0
        for row, size in enumerate(sizes):
            if row > start and held + size > most:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if batch.num_rows > start:
            yield batch.slice(start)
    give_back()


def give_back() -> None:
    """Return freed memory to the machine: workers serve one stage after the other, and each would keep its peak."""
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def small_batches(spark: SparkSession) -> None:
    """From now on the session moves ``BATCH_ROWS`` rows at a time to Python, whoever runs what it plans."""
    spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def per_worker(name: str, make: Callable[[], Any]) -> Any:
    """What ``make`` returns, once a Python worker process.

    This package travels to the workers by value, so its own module variables start anew
    with every task; a module of the process does not.
    """
    held = sys.modules.setdefault("vouchwell_worker_state", types.ModuleType("vouchwell_worker_state")).__dict__
    if name not in held:
        held[name] = make()
    return held[name]
