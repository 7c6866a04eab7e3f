"""Exact top-k by inner product of integer vectors: elimination by a table of pivot distances."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.llm.arrow import in_arrow
from recspark.llm.stages import cut, plain, small_side
from recspark.llm.vectors import finite, id_array, ids_of, matrices, numbered

#: Sums of products below this are exact in double precision.
EXACT = float(1 << 53)
SALTS = 64


@dataclass
class Pivots:
    """Of one dimension: the pivots, and a bounded sample of rows that gives queries a first bound."""

    pivots: np.ndarray
    sample: np.ndarray
    uids: np.ndarray


def choose(sample: np.ndarray, most: int) -> np.ndarray:
    """Farthest-first pivots: each is the sample vector farthest from those before it."""
    far = np.full(len(sample), np.inf)
    picked: list[int] = []
    while len(picked) < min(most, len(sample)) and (far.max() > 0):
        p = int(np.argmax(far)) if picked else 0
        picked.append(p)
        far = np.minimum(far, ((sample - sample[p]) ** 2).sum(axis=1))
    return sample[picked]


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(((x - p) ** 2).sum(axis=1)) for p in pivots], axis=1) if len(pivots) else np.zeros((len(x), 0))


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of one vector with many; int64 arithmetic where doubles aren't exact."""
    if np.abs(q).max(initial=0.0) * np.abs(x).max(initial=0.0) * len(q) < EXACT:
        return (x @ q).astype(np.int64)
    return (x.astype(np.int64) * q.astype(np.int64)).sum(axis=1)


def _blocks(batches: Iterable[pa.RecordBatch], known: dict[int, Pivots], size: int, k: int, queries: bool) -> Iterator[pa.RecordBatch]:
    part, number = TaskContext.get().partitionId(), 0
    waiting: dict[int, list] = {}

    def out(d: int) -> pa.RecordBatch:
        nonlocal number
        parts = waiting.pop(d)
        x, ids, uids = (np.concatenate(p) for p in zip(*parts))
        have = known.get(d)
        dist = distances(x, have.pivots) if have else np.zeros((len(x), 0))
        least = np.full(len(x), np.iinfo(np.int64).min)
        if queries and have:
            for i, q in enumerate(x):
                s = products(q, have.sample)[have.uids != uids[i]]
                if len(s) >= k:
                    least[i] = np.partition(s, len(s) - k)[len(s) - k]
        number += 1
        raw = lambda a, t: pa.array([np.ascontiguousarray(a.astype(t)).tobytes()], type=pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([d], type=pa.int32()), pa.array([(part << 32) + number]), raw(ids, "<i8"), raw(uids, "<i8"), raw(x, "<f8"), raw(dist, "<f8"), raw(least, "<i8")],
                                          names=["dim", "block", "ids", "uids", "vecs", "dist", "least"])

    for batch in batches:
        ids, uid = ids_of(batch), batch.column(batch.schema.names.index("uid")).to_numpy()
        for d, rows, x in matrices(batch, np.float64):
            for at in range(0, len(rows), size):
                r = rows[at:at + size]
                waiting.setdefault(d, []).append((x[at:at + size], ids[r], uid[r]))
                if sum(len(p[0]) for p in waiting[d]) >= size:
                    yield out(d)
    for d in list(waiting):
        yield out(d)


def search_block(q: np.ndarray, q_uid: np.ndarray, dq: np.ndarray, least: np.ndarray, x: np.ndarray, ids: np.ndarray, uids: np.ndarray, dx: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, rows, scores): up to k best rows of a block for each query, those that may be among its k best.

    The score is (|q|^2 + |x|^2 - |q - x|^2) / 2, and |q - x| is at least the largest
    difference of the two vectors' distances to a pivot. Rows are evaluated in the order
    of the bound this gives, until no bound reaches the k-th score or ``least``.
    """
    nq, nx = (q * q).sum(axis=1), (x * x).sum(axis=1)
    for i in range(0, len(q), 32):
        gap = np.zeros((len(q[i:i + 32]), len(x)))
        for p in range(dx.shape[1]):
            np.maximum(gap, np.abs(dq[i:i + 32, p][:, None] - dx[:, p][None, :]), out=gap)
        total = nq[i:i + 32][:, None] + nx[None, :]
        bound = (total - gap * gap) / 2 + 1e-9 * total + 1  # the slack covers rounding
        bound[~np.isfinite(bound) | (total >= EXACT / 4)] = np.inf
        for j in range(len(bound)):
            own, b = i + j, bound[j]
            rows = np.flatnonzero((b >= least[own]) & (uids != q_uid[own]))
            rows = rows[np.argsort(-b[rows], kind="stable")]
            best_rows, best, at, step = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), 0, 128
            while at < len(rows) and (len(best) < k or b[rows[at]] >= best[-1]):
                now = rows[at:at + step]
                best_rows, best = np.concatenate([best_rows, now]), np.concatenate([best, products(q[own], x[now])])
                top = np.lexsort((uids[best_rows], ids[best_rows], -best))[:k]
                best_rows, best = best_rows[top], best[top]
                at, step = at + step, step * 2
            keep = best >= least[own]
            yield own, best_rows[keep], best[keep]


def _search(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            d = row["dim"]
            get = lambda c, t: np.frombuffer(row[c], dtype=t)  # noqa: E731, B023
            q_ids, q_uid, ids, uids = (get(c, "<i8") for c in ("q_ids", "q_uids", "ids", "uids"))
            q, x = get("q_vecs", "<f8").reshape(-1, d), get("vecs", "<f8").reshape(-1, d)
            dq, dx = get("q_dist", "<f8").reshape(len(q), -1), get("dist", "<f8").reshape(len(x), -1)
            found = list(search_block(q, q_uid, dq, get("least", "<i8"), x, ids, uids, dx, k))
            own = np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int64)
            rows = np.concatenate([f[1] for f in found])
            yield pa.RecordBatch.from_arrays([pa.array(q_uid[own]), pa.array(q_ids[own]), pa.array(uids[rows]), id_array(ids[rows]), pa.array(np.concatenate([f[2] for f in found]))],
                                             names=["q_uid", "query_id", "uid", "vec_id", "score"])


def quantised_top_k(df: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5, scale: int = 256,
                    pivots: int = 32, sample_rows: int = 2048, block: int = 2048) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query row's k rows of largest integer inner product.

    Components become floor(scale * x). Ties go to the smaller id (null last). A query
    row isn't its own candidate; another row of the same id is. Rows of null, empty or
    not finite vectors take no part, rows of another dimension aren't compared; null ids
    make no queries. Scores are 64-bit integers, as the result's type. A table without
    queries or candidates gives no rows.

    Pivots and a first bound for each query come from a bounded sample of rows (the
    ``sample_rows`` least by hash); they only order and skip work. Rows are packed into
    blocks with their pivot distances, each block of queries meets each block of rows
    of its dimension once, and gives at most k rows a query.
    """
    vec = plain(vec_col)
    value = F.transform(vec, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    rows = numbered(df, id_col, vec_col, finite(vec), value, is_query)
    sample = rows.orderBy(F.xxhash64("vec"), "uid").limit(sample_rows).select("uid", "vec").collect()
    known: dict[int, Pivots] = {}
    for d in {len(r["vec"]) for r in sample}:
        own = [r for r in sample if len(r["vec"]) == d]
        x = np.array([r["vec"] for r in own], dtype=np.float64)
        known[d] = Pivots(choose(x, pivots) if np.abs(x).max() < 2.0**24 else x[:0], x, np.array([r["uid"] for r in own]))
    shared = df.sparkSession.sparkContext.broadcast(known)
    fields = "dim int, block long, ids binary, uids binary, vecs binary, dist binary, least binary"
    cols = ["uid", "id", "vec"]
    cand = cut(in_arrow(rows.select(cols), lambda it: _blocks(it, shared.value, block, k, False), fields))
    quer = cut(in_arrow(rows.where("query").select(cols), lambda it: _blocks(it, shared.value, 256, k, True), fields))
    quer = quer.select("dim", F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("uids").alias("q_uids"), F.col("vecs").alias("q_vecs"), F.col("dist").alias("q_dist"), "least")
    size = quer.agg(F.sum(F.length("q_vecs") + F.length("q_dist"))).first()[0] or 0
    # pairs of block numbers, listed in SALTS tasks a dimension
    salt = F.pmod(F.xxhash64("block"), F.lit(SALTS)).cast("int").alias("salt")
    lists = quer.select("dim", "q_block", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    pairs = cand.select("dim", "block", salt).join(lists, ["dim", "salt"]).select("block", "q_block").repartition("block", "q_block")
    met = pairs.join(cand.drop("least"), "block").join(small_side(quer.drop("dim"), int(size), 1), "q_block")
    found = in_arrow(met, lambda it: _search(it, k), "q_uid long, query_id long, uid long, vec_id long, score long")
    order = Window.partitionBy("q_uid").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "uid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
