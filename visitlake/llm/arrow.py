"""Python over Arrow batches: where workers find the library, and batches in small pieces."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

LIBRARY = str(Path(__file__).resolve().parents[2])

#: Rows and bytes of text that are worked on at once; a single longer text is a piece of its own.
PIECE_ROWS = 512
PIECE_BYTES = 1 << 20


def show_library(spark: SparkSession) -> None:
    """Python workers also look for this library where the driver has found it, for sessions that
    were started elsewhere. On a cluster it is installed or sent with ``--py-files``."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if LIBRARY not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{known}:{LIBRARY}".strip(":")


def map_batches(df: DataFrame, run: Callable, schema: StructType | str) -> DataFrame:
    """``mapInArrow``; ``run`` gets and gives iterators of record batches. Its memory goes with the task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    show_library(df.sparkSession)
    return df.mapInArrow(task, schema)


def map_groups(
    df: DataFrame, by: list[Column | str], run: Callable, schema: StructType | str
) -> DataFrame:
    """``applyInArrow``; ``run`` gets and gives one table per group."""
    show_library(df.sparkSession)
    return df.groupBy(*by).applyInArrow(run, schema)


def pieces(batches: Iterable[pa.RecordBatch], column: int = -1) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of the batches, cut by the bytes of one text or binary column."""
    for batch in batches:
        values = batch.columns[column]
        sizes = pa.compute.fill_null(pa.compute.binary_length(values), 0).to_pylist()
        start = total = 0
        for row, size in enumerate(sizes):
            if row > start and (total + size > PIECE_BYTES or row - start >= PIECE_ROWS):
                yield batch.slice(start, row - start)
                start, total = row, 0
            total += size
        if start < batch.num_rows:
            yield batch.slice(start)


def give_back() -> None:
    """Return what a task no longer needs to the system: its Python worker lives on, beside those of other tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # only some C libraries have it
        pass
