"""Arrow batches inside tasks: bounded groups of rows, and rows back to batches."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes of an Arrow batch between the JVM and Python, where the session has not set its own.
BATCH_BYTES = 4 << 20
BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def in_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``df.mapInArrow(fn, schema)`` with small batches and workers that give their memory back.

    Batches are bounded in bytes (texts differ in length by orders of magnitude), unless the
    session's value is already smaller. Workers are reused by later stages, so what a task
    has freed goes back to the system when the task ends.
    """
    conf = df.sparkSession.conf
    if int(conf.get(BATCH_KEY, str(1 << 30)).rstrip("b")) > BATCH_BYTES:
        conf.set(BATCH_KEY, str(BATCH_BYTES))
    return df.mapInArrow(lambda it: _tidy(fn(it)), schema)


def _tidy(rows: Iterator) -> Iterator:
    try:
        yield from rows
    finally:
        give_back()


def give_back() -> None:
    """Return freed memory to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def groups(batches: Iterable[pa.RecordBatch], column: str, most_bytes: int, most_rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Batches cut so that ``column`` holds about ``most_bytes`` at most (one row at least).

    Rows are never cut or dropped; a single longer text is a group of its own.
    """
    import numpy as np

    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.names.index(column))
        wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
        off = np.frombuffer(col.buffers()[1], dtype=np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
        at = 0
        while at < len(col):
            end = int(np.searchsorted(off, off[at] + most_bytes, side="right")) - 1
            end = min(len(col), max(at + 1, end), at + most_rows)
            yield batch.slice(at, end - at)
            at = end


def texts(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """The column as UTF-8 bytes, null as None."""
    col = batch.column(batch.schema.names.index(column))
    return col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()).to_pylist()
