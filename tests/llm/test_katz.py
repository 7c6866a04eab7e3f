import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from recspark.llm.katz import GoodTuring, pack_sorted, score, unpack_sorted
from recspark.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) + ["</s>"]


class Brute:
    """Katz by its definition: a history's weight shares what is left among all words not seen after it."""

    def __init__(self, texts, order):
        self.order, self.count = order, {m: Counter() for m in range(1, order + 1)}
        for t in texts:
            s = ["<s>"] * (order - 1) + tokens(t)
            for m in self.count:
                self.count[m].update(tuple(s[i - m + 1:i + 1]) for i in range(order - 1, len(s)))
        self.words = [w for w, in self.count[1]]
        self.n = sum(self.count[1].values())
        self.after, self.seen = defaultdict(set), Counter()
        for m in range(2, order + 1):
            for g, c in self.count[m].items():
                self.after[g[:-1]].add(g[-1])
                self.seen[g[:-1]] += c
        self.level = {m: GoodTuring(*(np.array(x) for x in zip(*sorted(Counter(c.values()).items())))) for m, c in self.count.items()} if texts else {}
        self.weights = {}

    def discounted(self, g):
        return float(self.level[len(g)].discounted(np.array([self.count[len(g)][g]]))[0])

    def p(self, w, h):
        if not h:
            if not self.n:
                return 1.0
            return self.discounted((w,)) / self.n if (w,) in self.count[1] else 1 - sum(self.discounted((x,)) for x in self.words) / self.n
        if (*h, w) in self.count[len(h) + 1]:
            return self.discounted((*h, w)) / self.seen[h]
        return self.weight(h) * self.p(w, h[1:])

    def weight(self, h):
        if not self.seen[h]:
            return 1.0
        if h not in self.weights:
            left = 1 - sum(self.p(w, h) for w in self.after[h])
            self.weights[h] = left / sum(self.p(w, h[1:]) for w in [*self.words, "<unk>"] if w not in self.after[h])
        return self.weights[h]

    def score(self, text):
        s = ["<s>"] * (self.order - 1) + tokens(text)
        return sum(math.log10(self.p(s[i], tuple(s[i - self.order + 1:i]))) for i in range(self.order - 1, len(s)))

    def base(self, text):
        return sum(math.log10((self.count[1][(w,)] + 0.5) / (self.n + 0.5 * (len(self.words) + 1))) for w in tokens(text))


def made(n=150):
    r = random.Random(4)
    words = [f"w{int(r.paretovariate(0.8))}" for _ in range(300)] + ["Éa", "É,", "THE", "the", "😀", "x\x00y"]
    rows = [(i, " ".join(r.choices(words, k=r.randint(0, 40)))) for i in range(n)]
    return rows + [(900, None), (901, ""), (902, " \n\t "), (903, "never seen Words"), (904, "the the the"), (None, "null id w1"), (5, rows[5][1]), (906, "a\x0bb\x0cc\r\nd\xa0e")]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_equals_brute_force(spark, order):
    rows = made()
    taught = lambda i: i is not None and i % 3 != 1
    b = Brute([t for i, t in rows if taught(i)], order)
    want = {}
    for i, t in rows:
        want.setdefault((i, len(tokens(t)), sum((w,) in b.count[1] for w in tokens(t))), []).append((b.base(t), b.score(t)))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"row": F.lit("clash"), "n": F.lit(1)}).repartition(4)
    for bounds in ({}, {"block_tokens": 70, "part_bytes": 50, "shard_bytes": 100}):
        got = score(df, F.col("doc_id") % 3 != 1, order=order, **bounds).collect()
        assert len(got) == len(rows)
        for x in got:
            assert x.train == taught(x.doc_id) and x.train_tokens == b.n
            assert min(abs(x.base_score - base) + abs(x.score - s) for base, s in want[x.doc_id, x.n_tokens, x.n_known]) < 1e-8


@pytest.mark.parametrize("order", [2, 3])
def test_histories_sum_to_one(order):
    b = Brute([t for _, t in made(60)], order)
    for h in [("<s>",), ("w1",), ("w2",), ("the",), ("never",)]:
        h = ("<s>",) * (order - 1 - len(h)) + h
        assert abs(sum(b.p(w, h) for w in [*b.words, "<unk>"]) - 1) < 1e-9


def test_no_rows_and_nothing_taught(spark):
    df = spark.createDataFrame(made(10), "doc_id long, text string")
    assert score(df.limit(0), F.lit(True)).collect() == []
    got = score(df, F.lit(None).cast("boolean")).collect()
    assert len(got) == 18 and all(abs(x.score) < 1e-9 and abs(x.base_score) < 1e-9 and x.n_known == 0 and x.train_tokens == 0 for x in got)


def test_discounts_of_every_count_lie_below_one():
    for counts in ([1], [1, 1, 2], [3, 3, 3], [1, 2, 3, 4, 5], list(range(1, 400)), [1] * 1000 + [2] * 300 + [3] * 150 + [9, 2000]):
        r, n = np.unique(counts, return_counts=True)
        g = GoodTuring(r, n)
        d = g.discounted(r) / r
        assert (d > 0).all() and (d < 1).all() and 0 < g.left < 1
    # counts that fall as Zipf has it: the estimate of 1 is 2 n2 / n1
    g = GoodTuring(np.array([1, 2, 3]), np.array([100000, 20000, 9000]))
    assert abs(g.discounted(np.array([1]))[0] - 0.4) < 1e-12


def test_packed_keys():
    k = np.sort(np.random.default_rng(1).integers(0, 2**64, 1000, dtype=np.uint64))
    assert (unpack_sorted(pack_sorted(k)) == k).all() and len(unpack_sorted(pack_sorted(k[:0]))) == 0


def test_given_documents_and_held_out_gain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    got = {x.doc_id: x for x in QUERIES["op12_katz_backoff"](spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(docs) and {i for i, x in got.items() if x.held_out} == {x.doc_id for x in docs if held(x.doc_id)}
    b = Brute([x.text for x in docs if not held(x.doc_id)], 2)
    for x in docs[:40]:
        y = got[x.doc_id]
        assert (y.n_tokens, y.n_known, y.train_tokens) == (len(tokens(x.text)), sum((w,) in b.count[1] for w in tokens(x.text)), b.n)
        assert abs(y.base_score - b.base(x.text)) < 1e-6
    away = [x for x in got.values() if x.held_out]
    assert sum(x.score for x in away) > sum(x.base_score for x in away)
