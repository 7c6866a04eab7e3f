"""Quality by perplexity under an interpolated modified Kneser-Ney model of byte 5-grams."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recspark.llm.arrow import give_back, groups, in_arrow, texts
from recspark.llm.stages import cut, let_go, narrow, plain, small_side

ORDER = 5
EDGE = b"\xff"  # before and after a text; no UTF-8 byte
SYMBOLS = 256
KEY = (1 << 8 * ORDER) - 1  # bits of a 5-gram; the text's fold stands above them
BINS = 10_000  # of the quantile histograms, per unit of mean log probability


def keys(raws: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """The 5-grams that end at each byte and at the end of each text, as 40-bit numbers, and offsets."""
    joined = b"".join(EDGE * (ORDER - 1) + (r or b"") + EDGE for r in raws)
    b = np.frombuffer(joined, dtype=np.uint8)
    k = np.zeros(max(0, len(b) - ORDER + 1), dtype=np.int64)
    for j in range(ORDER):
        k <<= 8
        k |= b[j:len(b) - ORDER + 1 + j]
    n = np.array([len(r or b"") + 1 for r in raws], dtype=np.int64)
    off = np.concatenate([[0], np.cumsum(n)])
    own = np.ones(len(k), dtype=bool)
    after = off[1:-1] + np.arange(max(0, len(raws) - 1)) * (ORDER - 1)  # each text's pad lies between its 5-grams and the next ones
    for j in range(ORDER - 1):
        own[after + j] = False
    return k[own], off


def _folds(batch: pa.RecordBatch, off: np.ndarray) -> np.ndarray:
    """The fold of each 5-gram's text, above the 5-gram's bits."""
    return np.repeat(batch.column(batch.schema.names.index("fold")).to_numpy().astype(np.int64) << 8 * ORDER, np.diff(off))


def _coded(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the 5-grams of each text, with the text's fold, the distinct ones that they stand for, and offsets."""
    key, off = keys(texts(batch, "text"))
    key |= _folds(batch, off)
    code, distinct = pd.factorize(key, size_hint=len(key) >> 3)  # most come often; the table grows where they don't
    return code.astype(np.int32), distinct, off


def _count(batches: Iterable[pa.RecordBatch], most_bytes: int, most_keys: int) -> Iterator[pa.RecordBatch]:
    total = pd.Series(dtype="int64")

    def out():
        return pa.RecordBatch.from_arrays([pa.array(total.index.to_numpy().astype(np.int64)), pa.array(total.to_numpy().astype(np.int64))], names=["key", "c"])

    parts = []
    for batch in groups(batches, "text", most_bytes):
        code, distinct, _ = _coded(batch)
        parts.append(pd.Series(np.bincount(code, minlength=len(distinct)), index=distinct))
        if sum(map(len, parts)) > most_keys:
            total = pd.concat([total, *parts])
            total = total.groupby(level=0).sum()
            parts = []
            if len(total) > most_keys // 2:
                yield out()
                total = pd.Series(dtype="int64")
    total = pd.concat([total, *parts])
    total = total.groupby(level=0).sum()
    if len(total):
        yield out()


def _discounts(table: DataFrame, width: int) -> tuple[int, list[list[float]]]:
    """Rows of the table, and of each model D1, D2, D3+ from the numbers of n-grams counted once to four times."""
    times = [F.coalesce(F.sum((F.col(f"c{f}") == k).cast("long")), F.lit(0)) for f in range(width) for k in (1, 2, 3, 4)]
    rows, *found = table.agg(F.count("*").alias("rows"), *(t.alias(f"n{i}") for i, t in enumerate(times))).first()
    found = [float(x) for x in found]
    out = []
    for n1, n2, n3, n4 in (found[4 * f:4 * f + 4] for f in range(width)):
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        d = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
        out.append([min(max(x, 0.05), k + 0.95) for k, x in enumerate(d)])
    return rows, out


@dataclass
class Model:
    """Models side by side. Per order m: ``grams[m]`` (key, p0, p1, .., c) and ``backoff[m]`` (context, g0, g1, .., c).

    c is the largest number of sightings; p and g are null in a model that hasn't seen the key.
    """

    grams: dict[int, DataFrame]
    backoff: dict[int, DataFrame]
    empty: list[bool]


def fit(trusted: DataFrame, text_col: str = "text", most_bytes: int = 2 << 20, most_keys: int = 1 << 21, fold_col: str | None = None, folds: int = 1) -> Model:
    """The model of all trusted texts. Counts are summed inside tasks, then shuffled by 5-gram.

    The highest order discounts counts, the lower ones the number of distinct bytes
    that precede an n-gram; each order is interpolated with the next lower one, the
    lowest with the uniform distribution. All tables stay sharded by key. With
    ``fold_col`` (0 to ``folds`` - 1) there are ``folds`` models, the f-th of all texts
    but those of fold f; all are built by the same joins. An order has no more n-grams than
    the next higher one, which are counted, so a table is as many tasks wide as that needs.
    """
    rows = trusted.select(plain(text_col).alias("text"), (plain(fold_col) if fold_col else F.lit(0)).cast("long").alias("fold"))
    counted = in_arrow(rows, lambda it: _count(it, most_bytes, most_keys), "key long, c long")
    own = [F.sum(F.when(F.shiftright("key", 8 * ORDER) != f, F.col("c")).otherwise(0) if fold_col else F.col("c")).alias(f"c{f}") for f in range(folds)]
    table = {ORDER: cut(counted.groupBy(F.col("key").bitwiseAND(KEY).alias("k")).agg(*own).withColumnRenamed("k", "key"))}
    every = range(folds)
    wide = 8 * (2 * folds + 4)  # bytes of a row
    size, discounts = {}, {}
    size[ORDER], discounts[ORDER] = _discounts(table[ORDER], folds)
    table[ORDER] = narrow(table[ORDER], size[ORDER], wide)
    seen = lambda f: F.col(f"c{f}") > 0
    largest = lambda of: F.greatest(*of) if len(of) > 1 else of[0]
    for m in range(ORDER - 1, 0, -1):
        lower = table[m + 1].groupBy((F.col("key").bitwiseAND((1 << 8 * m) - 1)).alias("key")).agg(*(F.sum(seen(f).cast("long")).alias(f"c{f}") for f in every))
        table[m] = cut(narrow(lower, min(size[m + 1], SYMBOLS**m), wide))
        size[m], discounts[m] = _discounts(table[m], folds)
        table[m] = narrow(table[m], size[m], wide)
    grams, backoff = {}, {}
    lower = None
    for m in range(1, ORDER + 1):
        few = lambda df, m=m: narrow(df, size[m], wide)
        ctx = F.shiftright("key", 8).alias("ctx")
        off = [F.when(F.col(f"c{f}") == 0, 0.0).when(F.col(f"c{f}") == 1, d1).when(F.col(f"c{f}") == 2, d2).otherwise(d3) for f, (d1, d2, d3) in enumerate(discounts[m])]
        stats = table[m].groupBy(ctx).agg(*(F.sum(f"c{f}").alias(f"s{f}") for f in every), *(F.sum(off[f]).alias(f"d{f}") for f in every))
        share = [F.when(F.col(f"s{f}") > 0, F.col(f"d{f}") / F.col(f"s{f}")) for f in every]
        stats = few(stats)
        backoff[m] = cut(stats.select("ctx", *(share[f].alias(f"g{f}") for f in every), largest([F.col(f"s{f}") for f in every]).alias("c")))
        own = table[m].select("key", *(f"c{f}" for f in every), ctx, *((F.col(f"c{f}") - off[f]).alias(f"over{f}") for f in every)).join(stats, "ctx")
        own = few(own)
        own = own.withColumn("low", F.col("key").bitwiseAND((1 << 8 * (m - 1)) - 1))
        below = [F.lit(1.0 / SYMBOLS) for _ in every]
        if lower is not None:
            own = own.join(lower.select(F.col("key").alias("low"), *(F.col(f"p{f}").alias(f"p_low{f}") for f in every)), "low")
            below = [F.col(f"p_low{f}") for f in every]
        p = [F.when(seen(f), F.col(f"over{f}") / F.col(f"s{f}") + share[f] * below[f]) for f in every]
        grams[m] = lower = cut(few(own).select("key", *(p[f].alias(f"p{f}") for f in every), largest([F.col(f"c{f}") for f in every]).alias("c")))
    let_go(trusted.sparkSession)
    known = table[ORDER].agg(*(F.coalesce(F.max(seen(f)), F.lit(False)).alias(f"k{f}") for f in every)).first()
    return Model(grams, backoff, [not k for k in known])


def _head(df: DataFrame, key: str, values: list[str], most: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """The most sighted rows of a table, at most ``most``, sorted by key, NaN for null; whether that is the whole table."""
    level = F.floor(F.log2("c") * 4).cast("int")
    levels = sorted(((r["l"], r["n"]) for r in df.groupBy(level.alias("l")).agg(F.count("*").alias("n")).collect()), reverse=True)
    have, least = 0, None
    for l, n in levels:
        if have + n > most:
            break
        have, least = have + n, l
    if least is None:
        return np.zeros(0, dtype=np.int64), np.zeros((0, len(values)), dtype=np.float32), not levels
    rows = df.where(level >= least).select(key, *(F.coalesce(F.log(v), F.lit(float("nan"))).cast("float").alias(v) for v in values)).toArrow()
    k = rows.column(0).to_numpy()
    order = np.argsort(k)
    return k[order], np.stack([rows.column(1 + f).to_numpy()[order] for f in range(len(values))], axis=1), have == sum(n for _, n in levels)


def _find(at: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Place of each key among sorted keys, -1 where absent."""
    if not len(at):
        return np.full(len(key), -1)
    p = np.minimum(np.searchsorted(at, key), len(at) - 1)
    return np.where(at[p] == key, p, -1)


def _value(at: np.ndarray, values: np.ndarray, key: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a head table holds each key for the model of its fold, and the value."""
    p = _find(at, key)
    x = values[p, fold] if len(at) else np.full(len(key), np.nan)
    return (p >= 0) & ~np.isnan(x), x


def local_scores(key: np.ndarray, heads: dict) -> np.ndarray:
    """Log probability of each 5-gram, in the model of its fold, from the head tables; NaN where they can't tell."""
    out, sofar = np.full(len(key), np.nan), np.zeros(len(key))
    open_, fold = np.arange(len(key)), key >> 8 * ORDER
    for m in range(ORDER, 0, -1):
        (k, v, all_grams), (ctx, g, all_ctx) = heads["grams", m], heads["backoff", m]
        low = key[open_] & ((1 << 8 * m) - 1)
        known, x = _value(k, v, low, fold[open_])
        out[open_[known]] = sofar[open_[known]] + x[known]
        if not all_grams:
            return out
        open_, low = open_[~known], low[~known]
        known, x = _value(ctx, g, low >> 8, fold[open_])
        sofar[open_[known]] += x[known]
        if not all_ctx:
            open_ = open_[known]
    out[open_] = sofar[open_] - np.log(SYMBOLS)
    return out


def _score(batches: Iterable[pa.RecordBatch], heads: dict, most_bytes: int) -> Iterator[pa.RecordBatch]:
    for batch in groups(batches, "text", most_bytes):
        code, distinct, off = _coded(batch)
        value = local_scores(distinct, heads)
        tail = np.isnan(value)
        value[tail] = 0.0
        docs = batch.num_rows
        s1, s2 = (np.add.reduceat(x[code], off[:-1]) for x in (value, value * value))
        at = np.flatnonzero(tail[code])
        doc = np.searchsorted(off, at, side="right") - 1
        pairs, count = np.unique(np.stack([doc, code[at]]), axis=1, return_counts=True) if len(at) else (np.zeros((2, 0), dtype=np.int64), np.zeros(0, dtype=np.int64))
        cuts = pa.array(np.searchsorted(pairs[0], np.arange(docs + 1)).astype(np.int32))
        rest = [batch.column(k) for k, c in enumerate(batch.schema.names) if c not in ("text", "fold")]
        yield pa.RecordBatch.from_arrays(
            [*rest, pa.array(np.diff(off) - 1), pa.array(s1), pa.array(s2), pa.ListArray.from_arrays(cuts, pa.array(distinct[pairs[1]])), pa.ListArray.from_arrays(cuts, pa.array(count.astype(np.int64)))],
            names=[*(c for c in batch.schema.names if c not in ("text", "fold")), "n_bytes", "s1", "s2", "tail", "times"],
        )


def _sharded(tail: DataFrame, model: Model, rows: int) -> DataFrame:
    """Log probability of each distinct tail 5-gram, of which there are ``rows``, by joins with the sharded tables order by order."""
    mine = lambda kind: F.element_at(F.array(*(f"{kind}{f}" for f in range(len(model.empty)))), F.shiftright("key", 8 * ORDER).cast("int") + 1)
    out = tail.withColumn("sofar", F.lit(0.0)).withColumn("v", F.lit(None).cast("double"))
    for m in range(ORDER, 0, -1):
        low = F.col("key").bitwiseAND((1 << 8 * m) - 1)
        out = out.withColumn("low", low).withColumn("ctx", F.shiftright("low", 8))
        out = narrow(out.join(model.grams[m].drop("c").withColumnRenamed("key", "low"), "low", "left"), rows, 64)
        out = narrow(out.join(model.backoff[m].drop("c"), "ctx", "left"), rows, 64)
        out = out.select("key", F.coalesce("v", F.col("sofar") + F.log(mine("p"))).alias("v"), (F.col("sofar") + F.coalesce(F.log(mine("g")), F.lit(0.0))).alias("sofar"))
    return out.select("key", F.coalesce("v", F.col("sofar") - float(np.log(SYMBOLS))).alias("v"))


def perplexity(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text", most_bytes: int = 2 << 20, head_rows: int = 1 << 19, fold_col: str | None = None) -> DataFrame:
    """Columns ``keep`` and ``n_bytes, mean, error, perplexity`` of every whole text.

    mean is the mean log probability of a byte (the end of the text counts as one),
    error its standard error. The most sighted ``head_rows`` rows of each model table
    are broadcast (a fixed bound, 4 MB a table and 2 MB a table and model); the 5-grams of a document that
    these can't settle are joined with the sharded tables, so the result is exact for
    any bound. Null and empty texts have 0 bytes and the score of an end alone; an
    empty model gives uniform probabilities. With ``fold_col`` a text of fold f is scored
    by the f-th model. One row per input row.
    """
    heads = {}
    for m in range(1, ORDER + 1):
        heads["grams", m] = _head(model.grams[m], "key", [f"p{f}" for f in range(len(model.empty))], head_rows)
        heads["backoff", m] = _head(model.backoff[m], "ctx", [f"g{f}" for f in range(len(model.empty))], head_rows)
    shared = docs.sparkSession.sparkContext.broadcast(heads)
    del heads
    give_back()
    rows = docs.select(*(plain(c).alias(f"k{i}") for i, c in enumerate(keep)), plain(text_col).alias("text"), (plain(fold_col) if fold_col else F.lit(0)).cast("long").alias("fold"))
    kinds = [f"k{i} {rows.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep))]
    scored = in_arrow(rows, lambda it: _score(it, shared.value, most_bytes), ", ".join([*kinds, "n_bytes long, s1 double, s2 double, tail array<long>, times array<long>"]))
    scored = cut(scored).withColumn("row", F.monotonically_increasing_id())
    tail = scored.select("row", F.explode(F.arrays_zip("tail", "times")).alias("x")).select("row", F.col("x.tail").alias("key"), F.col("x.times").alias("times"))
    keys_ = cut(tail.select("key").distinct())
    n_keys = keys_.count()
    value = _sharded(narrow(keys_, n_keys, 64), model, n_keys)
    more = tail.join(value, "key").groupBy("row").agg(F.sum(F.col("v") * F.col("times")).alias("m1"), F.sum(F.col("v") * F.col("v") * F.col("times")).alias("m2"))
    n = F.col("n_bytes") + 1
    mean = (F.col("s1") + F.coalesce("m1", F.lit(0.0))) / n
    spread = F.greatest(F.lit(0.0), (F.col("s2") + F.coalesce("m2", F.lit(0.0))) / n - mean * mean)
    return scored.join(more, "row", "left").select(
        *(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)), "n_bytes", mean.alias("mean"), F.sqrt(spread / n).alias("error"), F.exp(-mean).alias("perplexity"))


def quantiles(scored: DataFrame, lang: str, low: float, high: float, low_of: str = "mean", high_of: str = "mean") -> DataFrame:
    """Per language the ``low`` quantile of ``low_of`` and the ``high`` one of ``high_of``, and over all rows as language ``null, overall true``.

    Read off exact counts in bins of 1 / BINS, which are few however many rows there are.
    """
    side = lambda upper, of: F.struct(F.lit(upper).alias("upper"), F.floor(F.col(of) * BINS).alias("bin"))
    bins = scored.select(plain(lang).alias("lang"), F.explode(F.array(side(False, low_of), side(True, high_of))).alias("x"))
    bins = bins.groupBy("lang", F.col("x.upper").alias("upper"), F.col("x.bin").alias("bin")).agg(F.count("*").alias("n"))
    bins = bins.withColumn("overall", F.lit(False)).unionByName(bins.groupBy("upper", "bin").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("lang"), "upper", "bin", "n", F.lit(True).alias("overall")))
    key = ["overall", "lang", "upper"]
    bins = bins.withColumn("upto", F.sum("n").over(Window.partitionBy(key).orderBy("bin"))).withColumn("all", F.sum("n").over(Window.partitionBy(key)))
    edge = lambda q, upper: F.min(F.when((F.col("upper") == upper) & (F.col("upto") >= F.ceil(q * F.col("all"))), F.col("bin"))) / BINS
    return bins.groupBy("overall", "lang").agg(edge(low, False).alias("low"), edge(high, True).alias("high"), F.max("all").alias("rows"))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", low: float = 0.005, high: float = 0.995,
             slack: float = 0.1, folds: int = 5, prior_rows: int = 20, errors: float = 3.0, unsure: float = 2.0, head_rows: int = 1 << 19, keep: list[str] | None = None) -> DataFrame:
    """``id_col, lang_col, n_bytes, perplexity, low, high, trusted, kept`` and columns ``keep`` of every row of ``docs``.

    Trusted texts are those whose id is labelled quality 1 and never quality 0 or
    toxic. Every text belongs to one of ``folds`` folds by a hash of the text (so copies
    stay together) and is scored by the model of the trusted texts of all other folds, so
    no text by a model that knows it, and every trusted text calibrates. What counts is the
    mean log probability of a byte, length-adjusted: plus ``errors`` standard errors (of the
    text itself) for the lower edge, minus as many for the upper one. ``low`` and ``high``
    are quantiles of just these numbers over the trusted texts of the language, so short
    ones don't widen the range for long ones. A text goes if its number is beyond the
    quantile by more than ``slack`` and ``unsure`` over the root of the number of texts
    behind the quantile: too unlikely is noise, too likely is repetition.

    A language's quantiles and margin are weighed with those of all languages together, by its
    number of trusted texts against ``prior_rows``; a null language, or one without trusted
    texts, is held against those of all languages alone.
    Texts without a non-blank character go. Where no other fold holds a trusted text, and
    so without trusted texts at all, nothing else goes. Null ids are never trusted;
    repeated rows are judged one by one; an empty table gives no rows.
    """
    marks = labels.groupBy(plain("doc_id").cast("long").alias("t_id")).agg(F.min("quality").alias("q"), F.max("toxic").alias("t")).where("t_id is not null and q = 1 and coalesce(t, 0) = 0")
    marks = cut(marks.select("t_id"))
    side = small_side(marks, marks.count(), 16)
    more = [plain(c).alias(f"m{i}") for i, c in enumerate(keep or [])]
    named = [f"m{i}" for i in range(len(more))]
    rows = docs.select(plain(id_col).alias("id"), plain(text_col).alias("text"), plain(lang_col).cast("string").alias("lang"), *more)
    rows = rows.withColumns({"visible": F.coalesce(F.col("text").rlike(r"\S"), F.lit(False)), "fold": F.pmod(F.xxhash64("text"), F.lit(folds))})
    by_id = F.col("id").cast("long") == F.col("t_id")
    model = fit(rows.join(side, by_id, "left_semi"), fold_col="fold", folds=folds)
    blind = F.element_at(F.array(*map(F.lit, model.empty)), F.col("fold").cast("int") + 1)
    scored = perplexity(rows.withColumn("blind", blind), model, ["id", "lang", "blind", "visible", *named], head_rows=head_rows, fold_col="fold")
    error = errors * F.col("error")
    scored = cut(scored.join(side, by_id, "left").select("*", F.col("t_id").isNotNull().alias("trusted"), (F.col("mean") + error).alias("most"), (F.col("mean") - error).alias("least")).drop("t_id"))
    edges = cut(quantiles(scored.where("trusted and n_bytes > 0 and not blind"), "lang", low, high, "most", "least"))
    overall = edges.where("overall").select("low", "high", "rows").collect()
    all_low, all_high, all_rows = overall[0] if overall else (float("-inf"), float("inf"), 1)
    own = F.col("rows") / (F.col("rows") + prior_rows)
    by_lang = edges.where(~F.col("overall") & F.col("lang").isNotNull()).select(F.col("lang").alias("e_lang"), *((own * F.col(c) + (1 - own) * F.lit(float(x))).alias(c) for c, x in (("low", all_low), ("high", all_high))),
                                                                                (own / F.sqrt("rows") + (1 - own) / all_rows**0.5).alias("unsure"))
    out = scored.join(F.broadcast(by_lang) if by_lang.count() <= 10_000 else by_lang, F.col("lang") == F.col("e_lang"), "left")
    low_, high_ = F.coalesce("low", F.lit(all_low)), F.coalesce("high", F.lit(all_high))
    margin = slack + unsure * F.coalesce("unsure", F.lit(1 / all_rows**0.5))
    inside = F.col("blind") | ((F.col("most") + margin >= low_) & (F.col("least") - margin <= high_))
    return out.select(F.col("id").alias(id_col), F.col("lang").alias(lang_col), "n_bytes", "perplexity", low_.alias("low"), high_.alias("high"), "trusted",
                      (inside & F.col("visible")).alias("kept"), *(F.col(n).alias(c) for n, c in zip(named, keep or [])))
