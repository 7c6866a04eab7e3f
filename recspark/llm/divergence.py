"""How far the sources of a language differ in their words: in-mapper stripes, merged by term, give the divergences."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.llm.arrow import groups, in_arrow, texts
from recspark.llm.stages import cut, plain

SCALE = 1_000_000_000
#: What a byte of a text becomes: letters lose their case, bytes of other alphabets stay, all else ends a term.
FOLD = bytes(b if b >= 0x80 or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20 for b in range(256))


def terms(raw: bytes | None, chunk: int = 1 << 20) -> Iterator[list[bytes]]:
    """The terms of a whole text in lists of about ``chunk`` bytes; a cut never falls into a term."""
    folded, at = (raw or b"").translate(FOLD), 0
    while at < len(folded):
        end = folded.find(b" ", at + chunk)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


class Stripes:
    """Of each term of a language, by source: the documents that hold it and its occurrences."""

    def __init__(self):
        self.count: dict[tuple[str, str], Counter] = {}
        self.held: dict[tuple[str, str], Counter] = {}
        self.entries = 0

    def add(self, lang: str, source: str, raw: bytes | None) -> None:
        count = self.count.setdefault((lang, source), Counter())
        before, seen = len(count), set()
        for found in terms(raw):
            count.update(found)
            seen.update(found)
        self.held.setdefault((lang, source), Counter()).update(seen)
        self.entries += len(count) - before

    def spill(self) -> Iterator[pa.RecordBatch]:
        """One row per term of a language, with lists over its sources."""
        for lang in sorted({lang for lang, _ in self.count}):
            own = [(source, self.count[lang, source], self.held[lang, source]) for of, source in self.count if of == lang]
            term = pa.array([t for _, n, _ in own for t in n], type=pa.binary()).dictionary_encode()
            code = term.indices.to_numpy()
            order = np.argsort(code, kind="stable")
            size = [len(n) for _, n, _ in own]
            source = pa.array([s for s, _, _ in own]).take(pa.array(np.repeat(np.arange(len(own)), size)[order]))
            n = np.array([x for _, n, _ in own for x in n.values()], dtype=np.int64)[order]
            df = np.array([held[t] for _, n, held in own for t in n], dtype=np.int64)[order]
            off = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(term.dictionary)))]).astype(np.int32)
            rows = pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(term.dictionary), type=pa.string()), term.dictionary.cast(pa.string()), pa.ListArray.from_arrays(off, source),
                 pa.ListArray.from_arrays(off, pa.array(df)), pa.ListArray.from_arrays(off, pa.array(n))],
                names=["lang", "term", "source", "df", "n"])
            for at in range(0, rows.num_rows, 1 << 16):
                yield rows.slice(at, 1 << 16)
        self.__init__()


def _fold(batches: Iterable[pa.RecordBatch], most_bytes: int, most_entries: int) -> Iterator[pa.RecordBatch]:
    stripes = Stripes()
    for batch in groups(batches, "text", most_bytes):
        for lang, source, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch, "text")):
            stripes.add(lang, source, raw)
            if stripes.entries > most_entries:
                yield from stripes.spill()
    yield from stripes.spill()


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _sums(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(value[order], first)


def _met(size: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs i < j of entries of one stripe, for stripes of the given sizes one after the other, ``most`` at a time or one entry's."""
    end = np.repeat(np.cumsum(size), size)
    partners = end - np.arange(len(end)) - 1
    upto, at = np.cumsum(partners), 0
    while at < len(end):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + most, side="right")))
        n = partners[at:to]
        left = np.repeat(np.arange(at, to), n)
        yield left, left + 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = to


def _emit(batches: Iterable[pa.RecordBatch], ranks: int, most: int) -> Iterator[pa.RecordBatch]:
    """Of merged stripes: each source's foremost terms, and what sources that share a term add to their divergence."""
    names = ["part", "lang", "source", "item", "value"]
    for batch in batches:
        if not batch.num_rows:
            continue
        entries = batch.column(3)
        size = np.diff(entries.offsets.to_numpy())
        flat = entries.flatten()
        source, p, p0 = flat.field("source"), flat.field("p").to_numpy(), flat.field("p0").to_numpy()
        row = np.repeat(np.arange(batch.num_rows), size)
        q = batch.column(2).to_numpy()[row]
        over = np.flatnonzero(p > q)
        best = pa.table({"lang": batch.column(0).take(pa.array(row[over])), "source": source.take(pa.array(over)), "item": batch.column(1).take(pa.array(row[over])), "value": pa.array(divergence(p[over], q[over]))})
        best = best.take(pc.sort_indices(best, sort_keys=[("lang", "ascending"), ("source", "ascending"), ("value", "descending"), ("item", "ascending")])).combine_chunks()
        if best.num_rows:
            code = [best.column(c).combine_chunks().dictionary_encode().indices.to_numpy() for c in ("lang", "source")]
            new = np.concatenate([[True], (code[0][1:] != code[0][:-1]) | (code[1][1:] != code[1][:-1])])
            place = np.arange(best.num_rows)
            best = best.filter(pa.array(place - np.maximum.accumulate(np.where(new, place, 0)) < ranks))
            yield pa.RecordBatch.from_arrays([pa.array(["term"] * best.num_rows), *(best.column(c).combine_chunks() for c in names[1:])], names=names)
        # entries as numbers, in each stripe by source, so that a pair has one name
        lang, sources = batch.column(0).dictionary_encode(), source.dictionary_encode()
        by_name = pc.sort_indices(sources.dictionary)
        code = np.argsort(by_name.to_numpy())[sources.indices.to_numpy()]
        order = np.lexsort((code, row))
        code, p, p0, tongue = code[order].astype(np.int64), p[order], p0[order], lang.indices.to_numpy()[row].astype(np.int64)
        width, keys, values = len(sources.dictionary), [], []
        for i, j in _met(size, most):
            if len(i):
                k, v = _sums((tongue[i] * width + code[i]) * width + code[j], divergence(p[i], p[j]) - divergence(p[i], p0[j]) - divergence(p0[i], p[j]) + divergence(p0[i], p0[j]))
                keys.append(k)
                values.append(v)
        if keys:
            k, v = _sums(np.concatenate(keys), np.concatenate(values))
            named = sources.dictionary.take(by_name)
            yield pa.RecordBatch.from_arrays(
                [pa.array(["pair"] * len(k)), lang.dictionary.take(pa.array(k // width // width)), named.take(pa.array(k // width % width)), named.take(pa.array(k % width)), pa.array(v)], names=names)


def _p(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)), exactly."""
    wide = lambda c, digits=19: c.cast(f"decimal({digits},0)")
    return F.when(kept > 0, 1 + F.call_function("div", wide(F.lit(SCALE), 10) * wide(count + 2), wide(total + 2 * kept)))


def _f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = 10, ranks: int = 10,
          most_bytes: int = 2 << 20, most_entries: int = 3 << 18, most_pairs: int = 1 << 19) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every occurring pair of language and source.

    Terms are maximal runs of ASCII letters (A-Z in lower case) and characters beyond
    ASCII; a language keeps those in at least ``least_docs`` of its documents. With p of
    a source and q of another source, or of the whole language, a kept term adds
    floor((p - q)^2 / (p + q)). Part ``pair`` sums that over all kept terms for each other source
    of the language; part ``term`` has the ``ranks`` terms that set a source apart most (p > q). All
    arithmetic is exact, in integers. Ranks: by value, then by item in UTF-8 order.

    Null texts, languages and sources count as ''. A source without kept terms has pairs
    (value 0 if the language keeps none) and no terms; a language's only source has no pairs. Repeated
    rows are documents of their own, other columns are ignored, an empty table gives no rows.

    1. Tasks fold whole documents into stripes (term -> per source documents and
       occurrences) and spill them beyond ``most_entries``; spilled stripes are summed by
       (language, term, source) with map-side combine, then gathered by (language, term).
    2. Merged stripes give the totals; each entry gets its p, and p0, that of an absent term.
    3. A stripe yields the foremost terms and, for sources that share the term, by how
       much their divergence differs from that of two absent ones; tasks sum that by pair. What a
       term adds where only one source has it depends on its count alone, so it follows
       from the counts' histogram of each source: absent terms are never listed.
    """
    text = lambda c: F.coalesce(plain(c).cast("string"), F.lit(""))
    rows = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), plain(text_col).alias("text"))
    folded = in_arrow(rows, lambda it: _fold(it, most_bytes, most_entries), "lang string, term string, source array<string>, df array<long>, n array<long>")
    spilled = folded.select("lang", "term", F.explode(F.arrays_zip("source", "df", "n")).alias("x")).select("lang", "term", "x.*")
    summed = spilled.groupBy("lang", "term", "source").agg(F.sum("df").alias("df"), F.sum("n").alias("n"))
    merged = summed.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.sum("n").alias("n_lang"), F.collect_list(F.struct("source", "n")).alias("entries"))
    stripes = cut(merged.where(F.col("df") >= least_docs))

    flat = stripes.select("lang", "term", "n_lang", F.explode("entries").alias("x")).select("lang", "term", "n_lang", "x.source", "x.n")
    langs = stripes.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n_lang").alias("total_lang"))
    totals = flat.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    sources = rows.select("lang", "source").distinct().join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
    sources = sources.na.fill(0, ["kept", "total_lang", "total"]).withColumn("p0", _p(zero, F.col("total"), F.col("kept")))
    sources = cut(sources)

    placed = flat.join(sources, ["lang", "source"]).withColumn("p", _p(F.col("n"), F.col("total"), F.col("kept")))
    same = placed.groupBy("lang", "source", "p").agg(F.count("*").alias("times"))
    same = same.groupBy("lang", "source").agg(F.collect_list(F.struct("p", "times")).alias("counts"), F.sum("times").alias("present"))
    described = sources.join(same, ["lang", "source"], "left").select(
        "lang", "source", "kept", "p0", F.coalesce("present", zero).alias("present"), F.coalesce("counts", F.expr("cast(array() as array<struct<p:bigint,times:bigint>>)")).alias("counts"))
    described = cut(described)

    ready = placed.withColumn("q", _p(F.col("n_lang"), F.col("total_lang"), F.col("kept")))
    ready = ready.groupBy("lang", "term").agg(F.first("q").alias("q"), F.collect_list(F.struct("source", "p", "p0")).alias("entries"))
    emitted = cut(in_arrow(ready, lambda it: _emit(it, ranks, most_pairs), "part string, lang string, source string, item string, value long"))

    one = described.select("lang", "source", "kept", "p0", "present", "counts")
    two = described.select("lang", *(F.col(c).alias(f"{c}_2") for c in ("source", "p0", "present", "counts")))
    alone = lambda counts, p0: F.aggregate(counts, zero, lambda s, x: s + x["times"] * _f(x["p"], F.col(p0)))
    absent = (F.col("kept") - F.col("present") - F.col("present_2")) * _f(F.col("p0"), F.col("p0_2"))
    base = one.join(two, "lang").where("source <> source_2").select(
        "lang", "source", F.col("source_2").alias("item"), F.when(F.col("kept") > 0, alone(F.col("counts"), "p0_2") + alone(F.col("counts_2"), "p0") + absent).otherwise(0).alias("base"))
    met = emitted.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("met"))
    met = met.union(met.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "met"))
    pairs = base.join(met, ["lang", "source", "item"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", (F.col("base") + F.coalesce("met", zero)).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    foremost = emitted.where("part = 'term'").select("lang", "source", "part", "item", "value").withColumn("rank", rank).where(F.col("rank") <= ranks)
    return pairs.withColumn("rank", rank).unionByName(foremost)


def oracle(least_docs: int = 10, ranks: int = 10) -> str:
    """The same in SQL: every source of a language has a row for every kept term."""
    upper, lower = (bytes(range(a, a + 26)).decode() for a in (0x41, 0x61))
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), '{upper}', '{lower}') AS text FROM documents),
t AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n_lang FROM t GROUP BY ALL HAVING count(DISTINCT r) >= {least_docs}),
v AS (SELECT lang, count(*) AS v, sum(n_lang) AS total_lang FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY ALL),
f AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n,
        CAST(1 + (CAST({SCALE} AS HUGEINT) * (coalesce(n, 0) + 2)) // (total + 2 * v) AS BIGINT) AS p,
        CAST(1 + (CAST({SCALE} AS HUGEINT) * (n_lang + 2)) // (total_lang + 2 * v) AS BIGINT) AS q
      FROM g JOIN v ON v.lang = g.lang JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
      FROM f a JOIN f b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
p AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
m AS (SELECT * FROM p UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM f WHERE n > 0 AND p > q)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM m) WHERE part = 'pair' OR rank <= {ranks}
"""
