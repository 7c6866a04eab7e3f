"""Mixture-controlled packing: deficit round-robin over source queues into fixed windows."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recspark.llm.bpe import encode_batches
from recspark.llm.arrow import in_arrow
from recspark.llm.stages import cut, plain, small_side

#: Sum of the integer weights of all queues, about.
WEIGHT = 1 << 16


class Mixture:
    """How many tokens each queue has given once n tokens are out, for any n.

    Token j of queue s is due at time (j + 1) / weight[s]; tokens leave in the order
    of (due time, queue). That is deficit round-robin with a quantum of weight[s] a
    round, read at token resolution: a queue's credit at time t is t * weight[s], its
    deficit the credit less the tokens it has given, below one token while it lasts,
    and carried from window to window. As the state after n tokens has a closed form,
    a partition finds it for its own windows without the windows before. An empty
    queue leaves its share to the others.
    """

    def __init__(self, totals: list[int], weights: list[int]):
        self.total = np.array(totals, dtype=np.int64)
        self.weight = np.array(weights, dtype=np.int64)
        # queues in the order in which they run dry; the token counts at which they do
        self.order = sorted(range(len(totals)), key=lambda s: (totals[s] / weights[s], s))
        self.phase = []  # (tokens out when the phase ends, tokens of the queues run dry before, weight of the others)
        dry, weight = 0, sum(weights)
        for s in self.order:
            self.phase.append((dry + totals[s] * weight // weights[s], dry, weight, s))
            dry, weight = dry + totals[s], weight - weights[s]

    def given(self, n: np.ndarray) -> np.ndarray:
        """Row per element of n: tokens each queue has given among the first n."""
        n = np.asarray(n, dtype=np.int64)
        out = np.zeros((len(n), len(self.total)), dtype=np.int64)
        todo, gone = np.ones(len(n), dtype=bool), []
        for end, dry, weight, s in self.phase:
            now = np.flatnonzero(todo & (n <= end))
            live = np.ones(len(self.total), dtype=bool)
            live[gone] = False
            credit = _share(n[now] - dry, self.weight, weight)
            out[now] = np.where(live, np.minimum(credit, self.total), self.total)
            todo[now] = False
            gone.append(s)
        out[todo] = self.total
        left = n - out.sum(axis=1)
        while (left > 0).any():  # fewer than there are queues: the tokens due next
            rows = np.flatnonzero(left > 0)
            due = (out[rows] + 1) / self.weight
            due[out[rows] >= self.total] = np.inf
            out[rows, np.argmin(due, axis=1)] += 1
            left[rows] -= 1
        return out


def _share(n: np.ndarray, part: np.ndarray, whole: int) -> np.ndarray:
    """floor(n * part / whole) without overflow."""
    q, r = np.divmod(n[:, None], whole)
    return q * part + r * part // whole


def _tokens(batches: Iterable[pa.RecordBatch], path: str, end_id: int, queues: int, most_bytes: int, most_words: int) -> Iterator[pa.RecordBatch]:
    part, at, row = TaskContext.get().partitionId(), np.zeros(queues, dtype=np.int64), 0
    for rows, ids, off in encode_batches(batches, path, most_bytes, most_words):
        queue = rows.column(rows.schema.names.index("queue")).to_numpy(zero_copy_only=False)
        n = np.diff(off) + 1
        start = np.empty(len(n), dtype=np.int64)
        for q in np.unique(queue):
            own = queue == q
            end = at[q] + np.cumsum(n[own])
            start[own] = end - n[own]
            at[q] = end[-1]
        whole = np.insert(ids, off[1:], end_id).astype("<u4")
        cut_at = np.concatenate([[0], np.cumsum(n)])
        narrow = whole.astype("<u2") if not len(whole) or whole.max() < 1 << 16 else whole
        raw = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((cut_at * narrow.itemsize).astype(np.int32)), pa.py_buffer(narrow)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(n), part)), rows.column(rows.schema.names.index("id")), rows.column(rows.schema.names.index("queue")), pa.array(start), pa.array(n), raw],
            names=["slice", "id", "queue", "start", "n", "ids"],
        )


def _pieces(batches: Iterable[pa.RecordBatch], mixture: Mixture, window: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in (whole.slice(i, 512) for i in range(0, whole.num_rows, 512)):
            col = {c: batch.column(k) for k, c in enumerate(batch.schema.names)}
            queue, n = (col[c].to_numpy(zero_copy_only=False) for c in ("queue", "n"))
            first = (col["base"].to_numpy(zero_copy_only=False) + col["start"].to_numpy(zero_copy_only=False)).astype(np.int64)
            lo = _window_of(mixture, queue, first, window)
            hi = _window_of(mixture, queue, first + n - 1, window) + 1
            pieces = hi - lo
            doc = np.repeat(np.arange(len(n)), pieces)
            w = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces) + lo[doc]
            seen, back = np.unique(w, return_inverse=True)
            before, after = mixture.given(seen * window), mixture.given(np.minimum((seen + 1) * window, mixture.total.sum()))
            ahead = np.cumsum(after - before, axis=1) - (after - before)
            q = queue[doc]
            begin = np.maximum(first[doc], before[back, q])
            end = np.minimum(first[doc] + n[doc], after[back, q])
            keep = end > begin
            doc, w, back, q, begin, end = (x[keep] for x in (doc, w, back, q, begin, end))
            offset = ahead[back, q] + begin - before[back, q]
            begin, end = begin - first[doc], end - first[doc]
            raws = [_wide(x.as_py(), m) for x, m in zip(col["ids"], n.tolist())]
            crc = [zlib.crc32(raws[d][4 * a:4 * b]) for d, a, b in zip(doc.tolist(), begin.tolist(), end.tolist())]
            yield pa.RecordBatch.from_arrays(
                [col["id"].take(pa.array(doc)), *(pa.array(x) for x in (begin, end - begin)), pa.array(crc, type=pa.int64()), *(pa.array(x) for x in (n[doc], w, offset)), pa.array(q.astype(np.int32))],
                names=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "queue"],
            )


def _wide(raw: bytes, n: int) -> bytes:
    """Ids as little-endian 32-bit numbers, from 16 or 32 bits each."""
    return raw if len(raw) == 4 * n else np.frombuffer(raw, dtype="<u2").astype("<u4").tobytes()


def _window_of(mixture: Mixture, queue: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """The window that holds token ``at`` of its queue, by bisection on the tokens given."""
    lo = np.zeros(len(at), dtype=np.int64)
    hi = np.full(len(at), (int(mixture.total.sum()) + window - 1) // window, dtype=np.int64)
    # a start near the answer: the queue's share of what is out while all queues last
    guess = (at * (mixture.weight.sum() / mixture.weight[queue]) / window).astype(np.int64)
    for step in (1, 16, 4096):
        open_ = hi - lo > 2 * step
        for edge, low in ((guess - step, True), (guess + step, False)):
            edge = np.clip(edge, lo, hi)
            had = mixture.given(edge[open_] * window)[np.arange(open_.sum()), queue[open_]] <= at[open_]
            where = np.flatnonzero(open_)
            lo[where[had]] = np.maximum(lo[where[had]], edge[where[had]])
            hi[where[~had]] = np.minimum(hi[where[~had]], edge[where[~had]])
    while (hi - lo > 1).any():
        mid = (lo + hi) // 2
        had = mixture.given(np.minimum(mid * window, mixture.total.sum()))[np.arange(len(at)), queue] <= at
        lo, hi = np.where(had & (hi - lo > 1), mid, lo), np.where(~had & (hi - lo > 1), mid, hi)
    return lo


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", window: int = 4096,
         end_id: int = 2, targets: dict[str | None, float] | None = None, most_queues: int = 256,
         most_bytes: int = 16 << 20, most_words: int = 1_000_000) -> DataFrame:
    """Pieces of token sequences: ``id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset, queue``.

    A document is its ids (null text: none) and ``end_id``. Each source is a queue, a null
    source one of its own; beyond ``most_queues`` sources (a bound on what a task holds,
    not on rows) sources share queues by hash. Every window of ``window`` tokens takes from
    each queue its target proportion, by default the source's share of all tokens; what a
    window can't give exactly is the deficit that the next ones make up. All tokens are
    used: as queues run dry the others share their part, and only the last sequence is
    short. A queue is ordered by partition, then by row.

    Steps: encode once into a checkpointed table; sum tokens by (partition, queue), a
    running sum over partitions gives each its place in the queue; the pieces then follow
    row by row from ``Mixture``. Repeated and null ids are rows like any other; an empty
    table gives no pieces; other columns are ignored.
    """
    rows = docs.select(plain(id_col).alias("id"), plain(text_col).alias("text"), plain(source_col).cast("string").alias("source"))
    names = [r[0] for r in rows.select("source").distinct().orderBy(F.col("source").asc_nulls_first()).limit(most_queues + 1).collect()]
    if len(names) <= most_queues:
        number = F.coalesce(F.element_at(F.create_map(*[x for k, s in enumerate(names) if s is not None for x in (F.lit(s), F.lit(k))]), F.col("source")), F.lit(0)) if any(s is not None for s in names) else F.lit(0)
        queues = max(1, len(names))
    else:
        number, queues = F.pmod(F.xxhash64("source"), F.lit(most_queues)).cast("int"), most_queues
    kind = rows.schema["id"].dataType.simpleString()
    coded = in_arrow(rows.select("id", number.cast("int").alias("queue"), "text"), 
        lambda it: _tokens(it, path, end_id, queues, most_bytes, most_words), f"slice long, id {kind}, queue int, start long, n long, ids binary")
    coded = cut(coded)
    sums = coded.groupBy("slice", "queue").agg(F.sum("n").alias("tokens"))
    base = cut(sums.select("slice", "queue", (F.sum("tokens").over(Window.partitionBy("queue").orderBy("slice")) - F.col("tokens")).alias("base")))
    total = {r["queue"]: r["t"] for r in sums.groupBy("queue").agg(F.sum("tokens").alias("t")).collect()}
    totals = [total.get(q, 0) for q in range(queues)]
    wish = [float(t) for t in totals]
    if targets is not None:
        if len(names) > most_queues:
            raise ValueError("targets need a queue for each source; raise most_queues")
        wish = [float(targets.get(s, 0.0)) for s in names] or wish
    scale = WEIGHT / (sum(wish) or 1.0)
    weights = [max(1, round(w * scale)) for w in wish]
    mixture = Mixture(totals, weights)
    placed = coded.join(small_side(base, base.count(), 32), ["slice", "queue"]).select("id", "queue", "start", "n", "ids", "base")
    out = in_arrow(placed, lambda it: _pieces(it, mixture, window),
                            f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, queue int")
    return out.withColumnRenamed("id", id_col)
