"""Approximate nearest neighbours: multiprobe cross-polytope hashing, exact reranking."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.llm.arrow import in_arrow
from recspark.llm.stages import plain
from recspark.llm.vectors import finite, id_array, ids_of, matrices, numbered


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row (length a power of two), orthonormal."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def signs(table: int, turn: int, n: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, table, turn, n]).choice([-1.0, 1.0], n)


def rotated(x: np.ndarray, table: int, seed: int) -> np.ndarray:
    """The pseudo-rotation H D3 H D2 H D1 of a table, on rows scaled to length one and filled up with zeros."""
    n = 1 << max(1, (x.shape[1] - 1).bit_length())
    out = np.zeros((len(x), n))
    big = np.abs(x).max(axis=1, keepdims=True)
    unit = x / np.where(big > 0, big, 1)
    out[:, :x.shape[1]] = unit / np.linalg.norm(unit, axis=1, keepdims=True)
    for turn in range(3):
        out = hadamard(out * signs(table, turn, n, seed))
    return out


def axes(x: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` nearest signed axes of each row, nearest first: 2 * axis, plus 1 if negative."""
    both = np.stack([x, -x], axis=2).reshape(len(x), -1)
    return np.argsort(-both, axis=1, kind="stable")[:, :most]


def _hash(batches: Iterable[pa.RecordBatch], tables: int, probes: int, seed: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in (whole.slice(i, 512) for i in range(0, whole.num_rows, 512)):
            batch = pa.Table.from_batches([batch]).combine_chunks().to_batches()[0]
            for d, rows, x in matrices(batch, np.float64):
                for t in range(tables):
                    near = axes(rotated(x, t, seed), probes)
                    own = pa.array(np.repeat(rows, near.shape[1]))
                    key = (np.int64(d) << np.int64(32)) | (t << 24) | near.reshape(-1)
                    yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), *(batch.column(c).take(own) for c in range(batch.num_columns))],
                                                     names=["bucket", *batch.schema.names])


def _rerank(key: tuple, quer: pa.Table, cand: pa.Table, k: int) -> pa.Table:
    """Each query's k best rows of a bucket, by products in double precision."""
    fields = pa.schema([("q_uid", pa.int64()), ("query_id", pa.int64()), ("uid", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    if not quer.num_rows or not cand.num_rows:
        return fields.empty_table()
    quer = quer.rename_columns([c.removeprefix("q_") for c in quer.schema.names])
    cand, quer = (t.combine_chunks().to_batches()[0] for t in (cand, quer))
    (_, _, x), (_, _, q) = matrices(cand, np.float64)[0], matrices(quer, np.float64)[0]
    ids, uids = ids_of(cand), cand.column(cand.schema.names.index("uid")).to_numpy()
    q_ids, q_uids = ids_of(quer), quer.column(quer.schema.names.index("uid")).to_numpy()
    own, row, score = [], [], []
    for i in range(0, len(q), 64):
        rough = q[i:i + 64] @ x.T
        rough[q_uids[i:i + 64, None] == uids[None, :]] = -np.inf
        slack = 1e-9 * np.abs(q[i:i + 64]).max(axis=1) * np.abs(x).max() * x.shape[1]
        least = np.partition(rough, max(0, len(x) - k), axis=1)[:, max(0, len(x) - k)] if len(x) > k else np.full(len(rough), -np.inf)
        for j, r in enumerate(rough):
            # the sums of equal vectors must be equal whatever the matrix product's blocks were
            near = np.flatnonzero((r >= least[j] - slack[j]) & (q_uids[i + j] != uids))
            s = dot(q[i + j], x[near])
            top = np.lexsort((uids[near], ids[near], -s))[:k]
            own.append(np.full(len(top), i + j))
            row.append(near[top])
            score.append(s[top])
    own, row = np.concatenate(own), np.concatenate(row)
    return pa.Table.from_arrays([pa.array(q_uids[own]), pa.array(q_ids[own]), pa.array(uids[row]), id_array(ids[row]), pa.array(np.concatenate(score))], schema=fields)


def dot(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products in double precision, the same for equal rows."""
    return (x * q).sum(axis=1)


def nearest(df: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, tables: int = 8, probes: int = 16,
            seed: int = 17, block: int = 4096) -> DataFrame:
    """``query_id, rank, vec_id, score``: k rows of largest inner product found for each query row.

    Each of ``tables`` hash tables turns unit vectors by a pseudo-rotation (three rounds
    of random signs and a fast Hadamard transform) and files a row under its nearest signed
    axis; a query looks up its ``probes`` nearest axes of each table. Rows found are
    reranked by exact products of the original vectors; ties go to the smaller id (null
    last). Every row is indexed and every member of a probed bucket is evaluated; buckets
    are split into blocks of about ``block`` rows. Should the buckets hold fewer than k
    rows for a query, all rows of its dimension are searched for it.

    A query row isn't its own candidate; another row of the same id is. Null, empty,
    zero or not finite vectors take no part, null ids make no queries, rows of another
    dimension aren't compared; no rows give no rows.
    """
    vec = plain(vec_col)
    nonzero = F.exists(vec, lambda x: x.cast("double") != 0.0)
    rows = numbered(df, id_col, vec_col, finite(vec) & F.coalesce(nonzero, F.lit(False)), vec.cast("array<double>"), is_query)
    base = rows.select("uid", "id", "vec")
    queries = rows.where("query").select("uid", "id", "vec")
    fields = "bucket long, uid long, id long, vec array<double>"
    filed = in_arrow(base, lambda it: _hash(it, tables, 1, seed), fields)
    asked = in_arrow(queries, lambda it: _hash(it, tables, probes, seed), fields)
    found = _met(filed, asked, block, k)
    # queries whose buckets held too few rows: against every row
    enough = found.select("q_uid", "uid").distinct().groupBy("q_uid").agg(F.count("*").alias("n")).where(F.col("n") >= k)
    poor = queries.join(enough, F.col("uid") == F.col("q_uid"), "left_anti")
    size = F.size("vec").cast("long")
    rest = _met(base.select(size.alias("bucket"), "uid", "id", "vec"), poor.select(size.alias("bucket"), "uid", "id", "vec"), block, k)
    order = Window.partitionBy("q_uid").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "uid")
    best = found.union(rest).dropDuplicates(["q_uid", "uid"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


def _met(filed: DataFrame, asked: DataFrame, block: int, k: int) -> DataFrame:
    """Queries and rows of equal buckets, block by block, reranked."""
    parts = filed.groupBy("bucket").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    filed = filed.join(parts, "bucket").withColumn("part", F.pmod(F.xxhash64("uid"), F.col("parts")).cast("int"))
    asked = asked.join(parts, "bucket").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cols, key = ["bucket", "part", "uid", "id", "vec"], ["bucket", "part"]
    asked = asked.select(*(F.col(c).alias("q_" + c) for c in cols))
    met = asked.groupBy("q_bucket", "q_part").cogroup(filed.select(cols).groupBy(key))
    return met.applyInArrow(lambda kk, a, b: _rerank(kk, a, b, k), "q_uid long, query_id long, uid long, vec_id long, score double")
