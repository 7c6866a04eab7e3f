"""Vector columns: what takes part in a search, and rows of vectors packed into blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark.llm.stages import cut, plain

#: Stands for a null id inside blocks; such an id comes last among ties.
NO_ID = np.iinfo(np.int64).max


def finite(vec: Column) -> Column:
    """Not null, not empty, and every component a finite number."""
    ok = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return vec.isNotNull() & (F.size(vec) > 0) & F.coalesce(ok, F.lit(False))


def numbered(df: DataFrame, id_col: str, vec_col: str, take: Column, value: Column, query: Column) -> DataFrame:
    """``uid, id, query, vec`` of the rows where ``take`` holds; uid names a row, checkpointed so that it stays."""
    rows = df.select(plain(id_col).cast("long").alias("id"), F.coalesce(query, F.lit(False)).alias("query"), take.alias("take"), value.alias("vec"), plain(vec_col).alias("raw"))
    rows = cut(rows.where("take").select("id", "query", "vec"))
    return rows.select(F.monotonically_increasing_id().alias("uid"), "id", "query", "vec")


def matrices(batch: pa.RecordBatch, kind: type) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, row numbers, matrix) of each dimension in a batch with a ``vec`` column."""
    col = batch.column(batch.schema.names.index("vec"))
    off = col.offsets.to_numpy().astype(np.int64)
    flat = col.values.to_numpy(zero_copy_only=False).astype(kind)
    size = np.diff(off)
    out = []
    for d in np.unique(size).tolist():
        rows = np.flatnonzero(size == d)
        out.append((int(d), rows, flat[off[rows][:, None] + np.arange(d)]))
    return out


def ids_of(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(batch.schema.names.index("id")).fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def id_array(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, type=pa.int64(), mask=ids == NO_ID)
