"""Katz backoff over words: Good-Turing discounted counts, exactly normalised weights, scored by shards."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark.llm import rolling as ro
from recspark.llm.arrow import groups, in_arrow, texts
from recspark.llm.stages import cut, let_go, plain

U = np.uint64
START, END = U(0x5AB1E5EED0000001), U(0x5AB1E5EED0000003)  # symbols before and after the words of a text
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
ODD = U(ro.BASE)


# --- packed arrays ---------------------------------------------------------------------------

def pack(x: np.ndarray) -> bytes:
    """Numbers below 2^64, equal bytes of all of them together, compressed."""
    import zstandard

    planes = np.ascontiguousarray(x.astype(U).view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(blob: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(U)


def pack_sorted(x: np.ndarray) -> bytes:
    return pack(np.diff(x, prepend=U(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob), dtype=U)


# --- texts to blocks of symbols --------------------------------------------------------------

def _parts(raw: bytes, most: int) -> Iterator[bytes]:
    """A whole text in parts of about ``most`` bytes that end between words."""
    at = 0
    while len(raw) - at > most:
        end = at + most
        while end < len(raw) and not ro.SPACE[raw[end]]:
            end += 1
        yield raw[at:end]
        at = end
    yield raw[at:]


def _blocks(batches: Iterable[pa.RecordBatch], order: int, most_tokens: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows ``block, n, words, codes, parts``: texts as numbers of their block's distinct symbols.

    Each text, or part of a very long one, is preceded by the ``order`` - 1 symbols before it.
    """
    stamp, made, row = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32, 0, 0
    streams, parts, have = [], [], 0

    def out():
        code, words = pd.factorize(np.concatenate(streams))  # by first appearance: common words get small numbers
        table = pa.table({c: pa.array(v, type=t) for c, v, t in zip(("row", "id", "train", "first", "n"), zip(*parts), (pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64()))})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as to:
            to.write_table(table)
        return pa.RecordBatch.from_arrays(
            [pa.array([stamp + made]), pa.array([have]), *(pa.array([x], type=pa.binary()) for x in (pack(words), pack(code), sink.getvalue().to_pybytes()))],
            names=["block", "n", "words", "codes", "parts"])

    for batch in groups(batches, "text", most_bytes):
        for doc, train, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch, "text")):
            before = np.full(order - 1, START)
            pieces = list(_parts((raw or b"").translate(LOWER), most_bytes))
            for k, piece in enumerate(pieces):
                words = ro.words(piece)[0]
                if k == len(pieces) - 1:
                    words = np.append(words, END)
                if not len(words):
                    continue
                stream = np.concatenate([before, words])
                first = bool(order > 1 and before[-1] == START) or k == 0
                streams.append(stream)
                parts.append((stamp + row, doc, bool(train), first, len(stream)))
                before = stream[len(stream) - order + 1:]
                have += len(words)
                if have >= most_tokens:
                    yield out()
                    streams, parts, have, made = [], [], 0, made + 1
            row += 1
    if streams:
        yield out()


class Grams:
    """The distinct n-grams of a block, in the order of their keys, and which one ends at each position."""

    def __init__(self, words: bytes, codes: bytes, parts: bytes, order: int):
        table = pa.ipc.open_stream(parts).read_all()
        self.row, self.id = table["row"], table["id"]
        size, train, first = (table[c].to_numpy() for c in ("n", "train", "first"))
        end = np.cumsum(size)
        offset = np.arange(end[-1]) - np.repeat(end - size, size)
        part = np.repeat(np.arange(len(size)), size)
        real = offset >= order - 1
        self.at = np.flatnonzero(real)  # positions to be scored; the others are history
        self.part = part[self.at]
        self.starts = np.concatenate([[0], np.cumsum(size - order + 1)])[:-1]
        self.opening = first[self.part] & (offset[self.at] == order - 1)  # nothing but start symbols before
        self.trained = train[self.part]
        held = ~train[part]
        words = unpack(words)
        rank = np.argsort(words)
        place = np.empty(len(rank), dtype=np.int64)
        place[rank] = np.arange(len(rank))
        self.key, self.code, self.own, self.held = {1: words[rank]}, {1: place[unpack(codes).astype(np.int64)]}, {}, {}
        width = len(self.key[1])
        for m in range(2, order + 1):
            inside = np.flatnonzero(offset >= m - 1)
            code, pair = pd.factorize(self.code[m - 1][inside - 1] * width + self.code[1][inside])
            key = ro.mix(self.key[m - 1][pair // width] * ODD + self.key[1][pair % width], m)
            rank = np.argsort(key)
            place = np.empty(len(rank), dtype=np.int64)
            place[rank] = np.arange(len(rank))
            self.key[m] = key[rank]
            self.code[m] = np.full(len(offset), -1)
            self.code[m][inside] = place[code]
        for m in range(1, order + 1):
            n = len(self.key[m])
            self.own[m] = np.bincount(self.code[m][self.at[self.trained]], minlength=n)
            here = held & (self.code[m] >= 0)
            self.held[m] = np.bincount(self.code[m][here], minlength=n) > 0


def _asked(batches: Iterable[pa.RecordBatch], order: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Per n and shard: a block's keys, how often its training texts have them, and whether other texts do."""
    for batch in batches:
        for block, words, codes, parts in zip(*(batch.column(k).to_pylist() for k in range(4))):
            grams = Grams(words, codes, parts, order)
            out = []
            for m in range(1, order + 1):
                edge = np.searchsorted(grams.key[m] >> U(64 - bits), np.arange((1 << bits) + 1, dtype=U))
                for shard in np.flatnonzero(np.diff(edge)).tolist():
                    own = slice(edge[shard], edge[shard + 1])
                    out.append((m, shard, block, pack_sorted(grams.key[m][own]), pack(grams.own[m][own]), np.packbits(grams.held[m][own]).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))], names=["m", "shard", "block", "keys", "own", "held"])


ANSWER = "block long, m int, shard int, total binary, flags binary, r array<long>, n array<long>"


def _answered(asked: pa.Table) -> pa.Table:
    """One shard of one n: total counts, told to every block that asked, and how many n-grams have each count.

    The first block whose training texts hold an n-gram owns it: it alone adds it to sums over distinct n-grams.
    """
    asked = asked.sort_by("block")
    keys = [unpack_sorted(x) for x in asked["keys"].to_pylist()]
    size = [len(k) for k in keys]
    own = np.concatenate([unpack(x) for x in asked["own"].to_pylist()]).astype(np.int64)
    held = np.concatenate([np.unpackbits(np.frombuffer(x, dtype=np.uint8), count=n) for x, n in zip(asked["held"].to_pylist(), size)])
    keys = np.concatenate(keys)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    number = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))
    total = np.add.reduceat(own[order], first)
    others = np.maximum.reduceat(held[order], first)
    sure = np.flatnonzero(own[order] > 0)
    owner = np.zeros(len(keys), dtype=np.uint8)
    owner[sure[np.unique(number[sure], return_index=True)[1]]] = 1
    told, flags = np.empty(len(keys), dtype=np.int64), np.empty(len(keys), dtype=np.uint8)
    told[order], flags[order] = total[number], owner | others[number] << 1
    off = np.concatenate([[0], np.cumsum(size)])
    r, n = np.unique(total[total > 0], return_counts=True)
    blocks, m, shard = asked["block"].to_pylist(), asked["m"][0].as_py(), asked["shard"][0].as_py()
    rows = [(b, m, shard, pack(told[i:j]), pack(flags[i:j]), None, None) for b, i, j in zip(blocks, off, off[1:])]
    rows.append((None, m, shard, None, None, r.tolist(), n.tolist()))
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
    return pa.table({c: pa.array(v, type=t) for c, v, t in zip(("block", "m", "shard", "total", "flags", "r", "n"), zip(*rows), kinds)})


# --- discounts -------------------------------------------------------------------------------

@dataclass
class GoodTuring:
    """Discounts of counts from how many n-grams have each count (``r`` rising, ``n`` > 0).

    The expected count (r + 1) n[r + 1] / n[r] holds from 1 up as long as it differs clearly from the
    line fitted to log n over log r; the line holds beyond. Every count is discounted, so each
    history leaves mass for words not seen after it.
    """

    r: np.ndarray
    n: np.ndarray

    def __post_init__(self):
        r, n = self.r.astype(np.float64), self.n.astype(np.float64)
        self.total, self.kinds = int((self.r * self.n).sum()), int(self.n.sum())
        slope = -2.0
        if len(r) > 1:
            gap = np.concatenate([r[1:], [2 * r[-1] - r[-2]]]) - np.concatenate([[0.0], r[:-1]])
            slope = min(-1.1, float(np.polyfit(np.log(r), np.log(2 * n / gap), 1)[0]))
        self.power = slope + 1
        exact, have = [], dict(zip(self.r.tolist(), self.n.tolist()))
        k = 1
        while k in have and k + 1 in have:
            a, b = have[k], have[k + 1]
            turing, line = (k + 1) * b / a, k * (1 + 1 / k) ** self.power
            if turing >= k or abs(turing - line) <= 1.65 * math.sqrt((k + 1) ** 2 * b / a / a * (1 + b / a)):
                break
            exact.append(turing / k)
            k += 1
        self.exact = np.array([1.0, *exact])
        self.left = 1.0 - float((self.discounted(self.r) * self.n).sum()) / self.total if self.total else 1.0

    def discounted(self, count: np.ndarray) -> np.ndarray:
        """Discounted counts; 0 stays 0."""
        c = np.maximum(count, 1).astype(np.float64)
        share = np.where(count < len(self.exact), self.exact[np.minimum(count, len(self.exact) - 1)], (1 + 1 / c) ** self.power)
        return share * count


# --- scores ----------------------------------------------------------------------------------

SCORED = "row long, id long, train boolean, tokens long, known long, base double, score double, asked array<long>, times array<long>, context array<long>, left array<double>, below array<double>"


def _scored(block: pa.Table, answers: pa.Table, order: int, levels: dict[int, GoodTuring], texts_trained: int) -> pa.Table:
    """Of a block: a row per text part, with the histories whose weight it needs; a row of histories and what their owned n-grams take."""
    answers = answers.sort_by([("m", "ascending"), ("shard", "ascending")])
    grams = Grams(*(block[c][0].as_py() for c in ("words", "codes", "parts")), order)
    total, flags = {}, {}
    m_of = answers["m"].to_numpy()
    for m in range(1, order + 1):
        mine = answers.filter(pa.array(m_of == m))
        total[m] = np.concatenate([unpack(x) for x in mine["total"].to_pylist()]).astype(np.int64)
        flags[m] = np.concatenate([unpack(x) for x in mine["flags"].to_pylist()]).astype(np.int64)
    one, at, docs = levels[1], grams.at, len(grams.starts)
    count = total[1][grams.code[1][at]]
    base = np.log10((count + 0.5) / (one.total + 0.5 * (one.kinds + 1)))
    known = count > 0
    # from short histories to long ones: a seen n-gram's own probability replaces what its shorter one gave
    p = np.where(known, one.discounted(count) / max(1, one.total), one.left)
    lp = np.log10(p)
    asked, below_rows = [], []
    for m in range(2, order + 1):
        history = grams.code[m - 1][at - 1]
        of = np.where(grams.opening, texts_trained, total[m - 1][history])
        count = total[m][grams.code[m][at]]
        hit = count > 0
        less = levels[m].discounted(count)
        mine = np.full(len(total[m]), -1)
        trained = np.flatnonzero(grams.trained)
        mine[grams.code[m][at[trained]]] = trained
        mine = mine[(flags[m] & 1) > 0]
        mine = mine[(flags[m - 1][history[mine]] & 2) > 0]  # histories that no text beyond the training ones has need no weight
        if len(mine):
            h, inverse = np.unique(history[mine], return_inverse=True)
            left = np.bincount(inverse, weights=(count[mine] - less[mine]) / of[mine])
            below_rows.append((grams.key[m - 1][h].view(np.int64), left, np.bincount(inverse, weights=p[mine])))
        p = np.where(hit, less / np.maximum(of, 1), p)
        lp = np.where(hit, np.log10(np.maximum(p, 1e-300)), lp)
        need = np.flatnonzero(~hit & (of > 0))
        if len(need):
            width = len(grams.key[m - 1])
            both, n = np.unique(grams.part[need] * width + history[need], return_counts=True)
            asked.append((both // width, grams.key[m - 1][both % width].view(np.int64), n))
    doc, key, n = (np.concatenate(x) for x in zip(*asked)) if asked else (np.zeros(0, dtype=np.int64),) * 3
    order_ = np.argsort(doc, kind="stable")
    off = pa.array(np.searchsorted(doc[order_], np.arange(docs + 1)).astype(np.int32))
    sums = lambda x: np.add.reduceat(x, grams.starts)
    tokens = np.bincount(grams.part, minlength=docs)
    context, left, below = (np.concatenate(x) for x in zip(*below_rows)) if below_rows else (np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(0))
    nulls = lambda n, t: pa.nulls(n, type=t)
    lists, reals = pa.list_(pa.int64()), pa.list_(pa.float64())
    names = [x.split(" ")[0] for x in SCORED.split(", ")]
    top = [grams.row.combine_chunks(), grams.id.combine_chunks(), pa.array(grams.trained[grams.starts]), pa.array(tokens), pa.array(sums(known.astype(np.int64))), pa.array(sums(base)), pa.array(sums(lp)),
           pa.ListArray.from_arrays(off, pa.array(key[order_])), pa.ListArray.from_arrays(off, pa.array(n[order_])), nulls(docs, lists), nulls(docs, reals), nulls(docs, reals)]
    off = pa.array([0, len(context)], type=pa.int32())
    rest = [*(nulls(1, t) for t in (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), lists, lists)), *(pa.ListArray.from_arrays(off, pa.array(x)) for x in (context, left, below))]
    return pa.concat_tables([pa.table(dict(zip(names, top))), pa.table(dict(zip(names, rest)))])


def score(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", order: int = 2, block_tokens: int = 1 << 22, part_bytes: int = 4 << 20, shard_bytes: int = 16 << 20) -> DataFrame:
    """``id_col, train, n_tokens, n_known, train_tokens, base_score, score`` of every row; ids are longs.

    The model learns from the rows where ``train`` is true. A text's tokens are its words
    (runs of bytes other than space and 0x09-0x0D, A-Z in lower case) and one end; the words
    before a text's first are start symbols. With c the count of an n-gram in
    training and d Good-Turing's discount of its level:

        P(w | h) = d(c(h w)) c(h w) / c(h)         where h w was seen
                 = weight(h) P(w | shorter h)      where h was seen, but not w after it
                 = P(w | shorter h)                where h was not seen

    and weight(h) = (1 - sum of the first line) / (1 - sum of P(w | shorter h) over the same w), so that every
    history's probabilities sum to 1 over the training words, the end and one unknown word, to
    which the single words leave what their discounts freed. ``score`` is the sum of
    log10 P over a text, ``base_score`` that of single tokens with half a count added.

    1. Texts become blocks of ``block_tokens`` symbols (checkpointed): numbers of the block's distinct words.
    2. Each block sends the keys of its distinct n-grams with their counts, as sorted differences, to
       the shards that the keys' leading bits name; counts are summed there, and told to the
       blocks that asked in the order of asking. Keys spread evenly, however common a word is, and one
       block sends each once. c(h) is the count of h as an n-gram, so it needs no table of its own.
    3. Blocks work out everything but the weights. What a history's distinct followers take is
       summed by history; each n-gram is added by the one block that owns it.
    4. Weights, a table by history, are joined to the texts that need them: only texts outside the
       training rows back off.

    Words and n-grams are named by 64-bit keys; that two of a shard share one is a matter of 2^-64 a pair.
    Null texts are empty (an end alone); a null ``train`` is false; repeated rows are scored,
    and learnt from, one by one; without training rows every score is 0; other columns are
    ignored; an empty table gives no rows. Parts of very long texts are blocks' rows like whole texts.
    """
    rows = docs.select(plain(id_col).cast("long").alias("id"), F.coalesce(train, F.lit(False)).alias("train"), plain(text_col).alias("text"))
    blocks = cut(in_arrow(rows, lambda it: _blocks(it, order, block_tokens, part_bytes), "block long, n long, words binary, codes binary, parts binary"))
    tokens = blocks.agg(F.sum("n")).first()[0] or 0
    bits = max(4, math.ceil(math.log2(max(1, 6 * tokens / shard_bytes))))
    asked = in_arrow(blocks.select("block", "words", "codes", "parts"), lambda it: _asked(it, order, bits), "m int, shard int, block long, keys binary, own binary, held binary")
    answers = cut(asked.groupBy("m", "shard").applyInArrow(_answered, ANSWER))
    del asked
    let_go(docs.sparkSession)  # the keys' shuffle
    found = answers.where("block is null").select("m", F.explode(F.arrays_zip("r", "n")).alias("x")).groupBy("m", "x.r").agg(F.sum("x.n").alias("n")).orderBy("m", "r").toPandas()
    levels = {m: GoodTuring(*(found.loc[found["m"] == m, c].to_numpy().astype(np.int64) for c in ("r", "n"))) for m in range(1, order + 1)}
    texts_trained = rows.where("train").count()
    told = answers.where("block is not null").select("block", "m", "shard", "total", "flags")
    scored = cut(blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(lambda a, b: _scored(a, b, order, levels, texts_trained), SCORED))
    del blocks, answers, told
    let_go(docs.sparkSession)  # blocks and answers
    taken = scored.where("context is not null").select(F.explode(F.arrays_zip("context", "left", "below")).alias("x")).groupBy("x.context").agg(F.sum("x.left").alias("left"), F.sum("x.below").alias("below"))
    weights = cut(taken.select("context", F.log10(F.col("left") / F.greatest(F.lit(1) - F.col("below"), F.lit(1e-300))).alias("weight")))
    parts = scored.where("context is null")
    need = parts.select("row", F.explode(F.arrays_zip("asked", "times")).alias("x")).select("row", F.col("x.asked").alias("context"), "x.times")
    more = need.join(weights, "context").groupBy("row").agg(F.sum(F.col("weight") * F.col("times")).alias("more"))
    whole = parts.groupBy("row").agg(F.max("id").alias("id"), F.max("train").alias("train"), *(F.sum(c).alias(c) for c in ("tokens", "known", "base", "score")))
    return whole.join(more, "row", "left").select(
        F.col("id").alias(id_col), "train", F.col("tokens").alias("n_tokens"), F.col("known").alias("n_known"), F.lit(levels[1].total).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"), (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"))
