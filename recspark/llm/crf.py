"""Word-level language identification: a linear-chain conditional random field."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.llm import rolling as ro
from recspark.llm.arrow import give_back, groups, in_arrow
from recspark.llm.bpe import LETTER, classes
from recspark.llm.stages import cut, plain, small_side

U = np.uint64
HASHED = 1 << 18
AFFIXES = (3, 4, 5)
LINE = 0x0A


@dataclass
class Words:
    """Letter runs of texts: code points, bounds, fingerprints, and the line of each."""

    codes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    print: np.ndarray
    line: np.ndarray
    doc: np.ndarray


def split(texts: list[str | None]) -> Words:
    """Words are maximal runs of letters of the lowered text; lines end at a line feed or the text's end."""
    low = [(t or "").lower() for t in texts]
    codes = np.frombuffer(("\n".join(low) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = classes(codes) == LETTER
    edge = np.diff(np.concatenate([[False], letter, [False]]).astype(np.int8))
    s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    fp = ro.fingerprints(codes, s, e)
    line = np.cumsum(codes == LINE)[s] if len(s) else s
    ends = np.cumsum([len(t) + 1 for t in low])
    return Words(codes, s, e, fp, line, np.searchsorted(ends, s, side="right"))


def features(codes: np.ndarray, start: np.ndarray, end: np.ndarray, prints: np.ndarray, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, owning word) for each word: affixes, 2- and 3-grams with word bounds, lexicon entry."""
    n = len(start)
    size = end - start + 2
    off = np.concatenate([[0], np.cumsum(size)])
    who = np.repeat(np.arange(n), size)
    at = np.arange(off[-1]) - off[who] + start[who] - 1
    c = codes[np.clip(at, 0, len(codes) - 1)].astype(U)
    c[off[:-1]] = 1
    c[off[1:] - 1] = 1
    out, owner = [], []

    def add(value: np.ndarray, word: np.ndarray, tag: int) -> None:
        out.append((ro.mix(value, tag) >> U(64 - 18)).astype(np.int64))
        owner.append(word)

    k1, k2, k3 = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9)
    two = np.flatnonzero(who[1:] == who[:-1])
    add(c[two] * k1 + c[two + 1] * k2, who[two], 2)
    three = np.flatnonzero(who[2:] == who[:-2])
    add(c[three] * k1 + c[three + 1] * k2 + c[three + 2] * k3, who[three], 3)
    for p in AFFIXES:
        long = np.flatnonzero(size >= p + 2)
        for tag, first in ((10 + p, off[:-1][long] + 1), (20 + p, off[1:][long] - 1 - p)):
            value = np.zeros(len(long), dtype=U)
            for j in range(p):
                value = (value + c[first + j]) * k1
            add(value, long, tag)
    if len(lexicon):
        place = np.minimum(np.searchsorted(lexicon, prints), len(lexicon) - 1)
        known = np.flatnonzero(lexicon[place] == prints)
        out.append(HASHED + place[known])
        owner.append(known)
    f, w = np.concatenate(out), np.concatenate(owner)
    order = np.argsort(w, kind="stable")
    return f[order], w[order]


def forward_backward(score: np.ndarray, first: np.ndarray, size: np.ndarray, transition: np.ndarray, pairs: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of each word's label, and (if asked) expected label pairs, of many chains at once.

    Chain i has the ``size[i]`` words from ``first[i]``; chains advance together,
    longest first, so a step handles all chains still running.
    """
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    running = len(size) - np.searchsorted(size[::-1], np.arange(size[0]) + 1) if len(size) else np.zeros(0, dtype=int)
    emit = np.exp(score - score.max(axis=1, keepdims=True)) + 1e-12
    move = np.exp(transition - transition.max())
    alpha = np.empty_like(emit)
    for t, n in enumerate(running.tolist()):
        at = first[:n] + t
        a = emit[at] if t == 0 else (a[:n] @ move) * emit[at]
        a /= a.sum(axis=1, keepdims=True)
        alpha[at] = a
    gamma = np.empty_like(emit)
    expected = np.zeros_like(transition)
    for t in range(len(running) - 1, -1, -1):
        n = int(running[t])
        at = first[:n] + t
        b = np.ones((n, emit.shape[1]))
        if t + 1 < len(running):
            m = int(running[t + 1])
            ahead = emit[first[:m] + t + 1] * beta
            b[:m] = ahead @ move.T
            if pairs:
                a = alpha[at[:m]]
                z = np.einsum("ni,ij,nj->n", a, move, ahead)
                expected += (a / z[:, None]).T @ ahead * move
            b[:m] /= b[:m].sum(axis=1, keepdims=True)
        beta = b
        g = alpha[at] * b
        gamma[at] = g / g.sum(axis=1, keepdims=True)
    return gamma, expected


@dataclass
class Model:
    """Weights of the field: labels, lexicon fingerprints, word features x labels, label x label.

    ``least`` is, per label, half the median share of a training text's distinct words that are in the
    lexicon, less 1 over the root of the number of training texts: of few texts the lexicon tells little.
    """

    labels: list[str]
    lexicon: np.ndarray
    weight: np.ndarray
    transition: np.ndarray
    least: np.ndarray

    def scores(self, words: Words, at: np.ndarray) -> np.ndarray:
        """Summed feature weights of the words numbered ``at``."""
        out = np.zeros((len(at), len(self.labels)))
        for i in range(0, len(at), 1 << 15):
            part = at[i:i + (1 << 15)]
            f, w = features(words.codes, words.start[part], words.end[part], words.print[part], self.lexicon)
            out[i:i + len(part)] = np.add.reduceat(self.weight[f], np.searchsorted(w, np.arange(len(part))), axis=0)
        return out


def train(texts: list[str], langs: list[str], seed: int = 7, epochs: int = 4, rate: float = 0.4, penalty: float = 1e-5) -> Model:
    """Conditional maximum likelihood by AdaGrad on chains that switch language.

    The texts are cut into stretches of 2 to 30 words, which are dealt anew into
    chains of several languages, so the transitions learn to switch. The lexicon holds
    the words that at least two of the texts share.
    """
    labels = sorted(set(langs))
    words = split(texts)
    where = np.array([labels.index(x) for x in langs])
    seen = pd.DataFrame({"print": words.print, "doc": words.doc}).drop_duplicates().groupby("print").size()
    lexicon = np.sort(seen.index.to_numpy()[seen.to_numpy() >= 2].astype(U))
    weight = np.zeros((HASHED + len(lexicon), len(labels)), dtype=np.float64)
    transition = np.zeros((len(labels), len(labels)))
    sum_w, sum_t = np.full(weight.shape, 1e-2), np.full(transition.shape, 1e-2)
    r = np.random.default_rng(seed)
    once = pd.DataFrame({"print": words.print, "doc": words.doc}).drop_duplicates()
    shared = pd.Series(np.isin(once["print"].to_numpy().astype(U), lexicon)).groupby(once["doc"].to_numpy()).mean()
    usual = shared.groupby(where[shared.index.to_numpy()]).agg(["median", "size"])
    least = (usual["median"] / 2 - 1 / np.sqrt(usual["size"])).reindex(range(len(labels)), fill_value=0.0).to_numpy()
    model = Model(labels, lexicon, weight, transition, least)
    n = len(words.start)
    for _ in range(epochs if n else 0):
        cuts, at = [], 0
        change = np.append(np.flatnonzero(np.diff(words.doc)) + 1, n)
        while at < n:
            end = min(at + int(r.integers(2, 31)), int(change[np.searchsorted(change, at, side="right")]))
            cuts.append((at, end))
            at = end
        deal = r.permutation(len(cuts))
        for i in range(0, len(deal), 256):
            batch = [np.arange(*cuts[k]) for k in deal[i:i + 256]]
            own = np.concatenate(batch)
            lens = np.array([sum(len(x) for x in batch[k:k + 4]) for k in range(0, len(batch), 4)])
            first = np.cumsum(lens) - lens
            f, w = features(words.codes, words.start[own], words.end[own], words.print[own], lexicon)
            score = np.add.reduceat(weight[f], np.searchsorted(w, np.arange(len(own))), axis=0)
            gamma, expected = forward_backward(score, first, lens, transition, pairs=True)
            truth = where[words.doc[own]]
            grad = -gamma
            grad[np.arange(len(own)), truth] += 1
            inside = np.ones(len(own), dtype=bool)
            inside[first] = False
            inside = np.flatnonzero(inside)
            g_t = -expected
            np.add.at(g_t, (truth[inside - 1], truth[inside]), 1)
            used, back = np.unique(f, return_inverse=True)
            g_w = np.stack([np.bincount(back, weights=grad[w, k], minlength=len(used)) for k in range(len(labels))], axis=1)
            g_w -= penalty * len(own) * weight[used]
            sum_w[used] += g_w**2
            weight[used] += rate * g_w / np.sqrt(sum_w[used])
            sum_t += g_t**2
            transition += rate * g_t / np.sqrt(sum_t)
    model.weight = weight.astype(np.float32)
    return model


def _upper(share: np.ndarray, n: np.ndarray, z: float = 3.0) -> np.ndarray:
    """Upper bound, ``z`` standard errors away (Wilson), of the share behind one seen in n words; 1 for no words."""
    n = np.maximum(n, 1e-9)
    return (share + z * z / (2 * n) + z * np.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def _label(batches: Iterable[pa.RecordBatch], model: Model, most_bytes: int, most_words: int) -> Iterator[pa.RecordBatch]:
    known: dict[int, int] = {}
    table = np.zeros((1 << 12, len(model.labels)), dtype=np.float32)
    for batch in groups(batches, "text", most_bytes):
        texts = batch.column(batch.schema.names.index("text")).to_pylist()
        words = split(texts)
        docs = len(texts)
        total, count = np.zeros((docs, len(model.labels))), np.zeros(docs, dtype=np.int64)
        switch = np.zeros(docs, dtype=np.int64)
        met, kinds = np.zeros(docs), np.zeros(docs, dtype=np.int64)
        if len(words.start) and model.labels:
            local, distinct = pd.factorize(words.print)
            where = np.full(len(distinct), -1, dtype=np.int64)
            where[local[::-1]] = np.arange(len(local))[::-1]
            if len(known) > most_words:
                known.clear()
            to = np.array([known.get(x, -1) for x in distinct.tolist()], dtype=np.int64)
            new = np.flatnonzero(to < 0)
            to[new] = len(known) + np.arange(len(new))
            while len(known) + len(new) > len(table):
                table = np.concatenate([table, np.zeros_like(table)])
            known.update(zip(distinct[new].tolist(), to[new].tolist()))
            table[to[new]] = model.scores(words, where[new])
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(words.line)) + 1])
            gamma, _ = forward_backward(table[to[local]].astype(np.float64), cuts, np.diff(np.append(cuts, len(local))), model.transition)
            for k in range(len(model.labels)):
                total[:, k] = np.bincount(words.doc, weights=gamma[:, k], minlength=docs)
            count = np.bincount(words.doc, minlength=docs)
            own = np.unique(words.doc * len(distinct) + local)  # each word once a text: repeating it is no evidence
            kinds = np.bincount(own // len(distinct), minlength=docs)
            met = np.bincount(own // len(distinct), weights=np.isin(distinct.astype(U), model.lexicon)[own % len(distinct)], minlength=docs) / np.maximum(kinds, 1)
            best = gamma.argmax(axis=1)
            turn = np.flatnonzero((best[1:] != best[:-1]) & (words.doc[1:] == words.doc[:-1])) + 1
            switch = np.bincount(words.doc[turn], minlength=docs)
        share = total / np.maximum(count, 1)[:, None]
        if model.labels:
            top = share.argmax(axis=1)
            pred = [model.labels[k] if c else "und" for k, c in zip(top.tolist(), count.tolist())]
            score = np.clip(np.where(count > 0, share[np.arange(docs), top], 0.0), 0.0, 1.0)
            strange = (count > 0) & (_upper(met, kinds) < model.least[top])
        else:
            pred, score, strange = ["und"] * docs, np.zeros(docs), np.zeros(docs, dtype=bool)
        shares = pa.ListArray.from_arrays(pa.array(np.arange(docs + 1, dtype=np.int32) * len(model.labels)), pa.array(share.reshape(-1)))
        rest = [batch.column(k) for k, c in enumerate(batch.schema.names) if c != "text"]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(pred, type=pa.string()), pa.array(score), pa.array(count), pa.array(switch), shares, pa.array(strange)],
                                         names=[*(c for c in batch.schema.names if c != "text"), "lang_pred", "score", "n_words", "n_switches", "shares", "strange"])


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text modulo 4 is 2; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", train_rows: int = 2400, train_chars: int = 2000) -> Model:
    """A model from a bounded sample of labelled rows: about ``train_rows``, in equal parts per language, one text of each at least.

    Of each sampled text a stretch of ``train_chars`` characters is learnt from. Rows
    are chosen by a hash of their text, so the sample does not depend on partitions, and
    a language's share is one of its distinct texts, however many copies they have. All
    languages are learnt. Rows with a null text or language teach nothing; without any the model has no labels.
    """
    rows = docs.select(plain(text_col).alias("text"), plain(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    counts = cut(rows.select("lang", F.xxhash64("text").alias("h")).distinct().groupBy("lang").agg(F.count("*").alias("n_texts")))
    langs = counts.count()
    if not langs:
        return train([], [])
    each = max(1, train_rows // langs)
    draw = F.pmod(F.xxhash64("text", "lang"), F.lit(1 << 30))
    wanted = rows.join(small_side(counts, langs, 64), "lang").where(draw < F.least(F.lit(1.0), (1.5 * each + 3) / F.col("n_texts")) * (1 << 30))
    middle = F.greatest(F.lit(1), F.pmod(F.xxhash64("text"), F.greatest(F.lit(1), F.length("text") - train_chars)).cast("int"))
    sample = wanted.select("lang", draw.alias("draw"), F.substring(F.col("text"), middle, F.lit(train_chars)).alias("text")).distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "text"))
    sample = sample.withColumn("place", place).where(F.col("place") <= each).orderBy("draw", "text").collect()
    model = train([r["text"] for r in sample], [r["lang"] for r in sample])
    give_back()
    return model


def identify(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text", most_bytes: int = 1 << 20, most_words: int = 200_000) -> DataFrame:
    """Columns ``keep`` and ``lang_pred, score, n_words, n_switches, shares, strange`` of every whole text.

    Each word of a line gets label marginals by forward-backward over the line; a
    document's label has the largest mean marginal, which is its score. ``shares`` are
    the mean marginals in the order of ``model.labels``, ``n_switches`` counts changes
    of the likeliest label from word to word. A text is ``strange``, likely in no learned
    language, if the share of its distinct words that are in the lexicon is less than half of
    the share usual in its language, surely so (3 standard errors, so a short text needs
    a clearer case, and so does a language of few training texts); that does not depend on the number of labels. A text that is null or has no letter is
    ``und`` with score 0, and so is every text under a model without labels. Rows
    are returned one by one, repeated or not; an empty table gives none. Only the text
    enters a prediction. ``most_words`` bounds the kept word scores.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # bounded by the sample: hashed weights and its lexicon
    rows = docs.select(*(plain(c).alias(f"k{i}") for i, c in enumerate(keep)), plain(text_col).alias("text"))
    kinds = [f"k{i} {rows.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep))]
    out = in_arrow(rows, lambda it: _label(it, shared.value, most_bytes, most_words), ", ".join([*kinds, "lang_pred string, score double, n_words long, n_switches long, shares array<double>, strange boolean"]))
    return out.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)), "lang_pred", "score", "n_words", "n_switches", "shares", "strange")
