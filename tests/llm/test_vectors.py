import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from recspark.llm.cross_polytope import axes, dot, hadamard, nearest, rotated
from recspark.llm.pivots import choose, distances, quantised_top_k, search_block
from recspark.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, uid string, id int, vec double"


def rows(seed=0, n=160, d=6):
    r = np.random.default_rng(seed)
    out = [(i, [float(np.float32(x)) for x in r.normal(size=d)]) for i in range(n)]
    out += [(500 + i, out[3][1]) for i in range(12)] + [(-50, out[4][1]), (100, out[7][1]), (None, out[8][1]), (None, out[9][1])]
    out += [(700, None), (750, [1.0, None] + [0.0] * (d - 2)), (800, [float("nan")] * d), (850, [float("inf")] * d), (900, []), (950, [0.0] * d), (1000, [1.0, 2.0, 3.0]), (1050, [3.0, 2.0, 1.0])]
    return [(i, v, "u", 5, 0.5) for i, v in out]


def usable(v, zero):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v))


def brute(data, step, k, score, zero):
    data = [(i, v) for i, v, *_ in data if usable(v, zero)]
    out = []
    for a, (q, v) in enumerate(data):
        if q is None or q % step:
            continue
        s = sorted(((-score(v, w), i is None, i or 0) for b, (i, w) in enumerate(data) if b != a and len(w) == len(v)))
        out += [(q, n + 1, None if none else i, -x) for n, (x, none, i) in enumerate(s[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("block,pivots", [(2048, 32), (16, 3), (16, 0)])
def test_exact_top_k_equals_brute_force(spark, block, pivots):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    got = quantised_top_k(df, F.col("vec_id") % 50 == 0, block=block, pivots=pivots, sample_rows=40).collect()
    ints = lambda v: [math.floor(256 * x) for x in v]
    want = brute(data, 50, 5, lambda a, b: sum(x * y for x, y in zip(ints(a), ints(b))), True)
    assert sorted((tuple(g) for g in got), key=str) == want


def test_top_k_of_large_components(spark):
    data = [(i, [float(2.0**20 + i), float(-(2.0**19)), 3.0], "", 0, 0.0) for i in range(60)]
    got = quantised_top_k(spark.createDataFrame(data, SCHEMA), F.col("vec_id") % 50 == 0).collect()
    want = brute(data, 50, 5, lambda a, b: sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a, b)), True)
    assert sorted((tuple(g) for g in got), key=str) == want


def test_elimination_skips_work():
    r = np.random.default_rng(2)
    centre = r.normal(size=(20, 8)) * 2000
    x = np.floor(np.repeat(centre, 50, axis=0) + r.normal(size=(1000, 8)) * 20)
    p = choose(x, 16)
    q, seen = x[:1], []
    wrap = lambda: list(search_block(q, np.array([0]), distances(q, p), np.array([np.iinfo(np.int64).min]), x, np.arange(1000), np.arange(1000), distances(x, p), 5))
    import recspark.llm.pivots as m

    old = m.products
    m.products = lambda a, b: (seen.append(len(b)), old(a, b))[1]
    try:
        found = wrap()
    finally:
        m.products = old
    s = old(q[0], x)
    s[0] = -(2**60)
    assert found[0][1].tolist() == np.lexsort((np.arange(1000), -s))[:5].tolist() and sum(seen) < 1000


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert quantised_top_k(df, F.col("vec_id") % 50 == 0).count() == 0 and nearest(df, F.col("vec_id") % 20 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0, 0.0], "", 0, 0.0)], SCHEMA)
    assert quantised_top_k(one, F.col("vec_id") % 50 == 0).count() == 0 and nearest(one, F.col("vec_id") % 20 == 0).count() == 0


def test_rotation_keeps_lengths_and_axes_are_nearest():
    x = np.random.default_rng(1).normal(size=(5, 50))
    y = rotated(x, 3, 17)
    assert y.shape == (5, 64) and np.allclose(np.linalg.norm(y, axis=1), 1) and np.allclose(hadamard(hadamard(y)), y)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert np.allclose(y @ y.T, u @ u.T)
    top = axes(y, 2)
    for r, (a, b) in zip(y, top):
        both = sorted(((-s * r[i], 2 * i + (s < 0)) for i in range(64) for s in (1, -1)))
        assert [c for _, c in both[:2]] == [a, b]


def test_all_probes_are_exact(spark):
    data = rows(3)
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    got = nearest(df, F.col("vec_id") % 20 == 0, k=7, tables=2, probes=16, block=32).collect()
    want = brute(data, 20, 7, lambda a, b: float(dot(np.array(a), np.array([b]))[0]), False)
    assert sorted((tuple(g) for g in got), key=str) == want


def test_too_few_found_are_searched_in_full(spark):
    data = rows(4)
    df = spark.createDataFrame(data, SCHEMA)
    got = nearest(df, F.col("vec_id") % 20 == 0, k=7, tables=1, probes=1).collect()
    per = {}
    for g in got:
        per[g.query_id] = per.get(g.query_id, 0) + 1
    want = {}
    for q, *_ in brute(data, 20, 7, lambda a, b: 0.0, False):
        want[q] = want.get(q, 0) + 1
    assert per == want


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall(spark, sf):
    path = f"/root/testdata/{sf}"
    t = spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, x = np.array([r.vec_id for r in t]), np.array([r.embedding for r in t], dtype=np.float64)
    got, scores = {}, {}
    for r in QUERIES["op9_cross_polytope_ann"](spark, path).collect():
        got.setdefault(r.query_id, {})[r.rank] = r.vec_id
        scores[r.query_id, r.vec_id] = r.score
    hit = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        s = dot(x[q], x)
        s[q] = -np.inf
        want = ids[np.lexsort((ids, -s))[:20]].tolist()
        mine = got[ids[q]]
        assert sorted(mine) == list(range(1, 21))
        ranked = [scores[ids[q], mine[k]] for k in range(1, 21)]
        assert ranked == sorted(ranked, reverse=True)
        hit += len(set(want) & set(mine.values()))
        total += 20
    assert len(got) == int((ids % 20 == 0).sum()) and hit / total >= 0.9, hit / total
