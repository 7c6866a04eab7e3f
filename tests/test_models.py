"""Recommenders against brute force: cosine, item-CF, SVD, negatives."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from recspark.operators import factor as fa
from recspark.operators import models as mo
from recspark.operators import sampling as sa

CF_TINY = [(1, 1), (1, 2), (2, 1), (2, 2), (2, 3), (3, 3), (4, 4), (4, 3)]


def _df(spark, rows):
    return spark.createDataFrame(rows, "customer_unique_id long, product_id long")


def _brute_cos(rows):
    users = sorted({u for u, _ in rows})
    items = sorted({i for _, i in rows})
    x = np.zeros((len(users), len(items)))
    for u, i in rows:
        x[users.index(u), items.index(i)] += 1
    g = x.T @ x
    nrm = np.sqrt(np.diag(g))
    return items, g / np.outer(nrm, nrm)


@pytest.mark.parametrize("block", [512, 1])
def test_item_cosine_matches_dense(spark, block):
    items, c = _brute_cos(CF_TINY)
    got = {(r["item_i"], r["item_j"]): r["cosine"] for r in mo.item_cosine(_df(spark, CF_TINY), block_items=block).collect()}
    for a, ia in enumerate(items):
        for b, ib in enumerate(items):
            if a != b and c[a, b] > 0:
                assert got[(ia, ib)] == pytest.approx(c[a, b])
    assert all(ia != ib for ia, ib in got)
    assert len(got) == sum(1 for a in range(len(items)) for b in range(len(items)) if a != b and c[a, b] > 0)


def test_dense_user_salted_blocks(spark):
    rows = [(1, i) for i in range(300)] + [(2, 0), (2, 1)]
    small = mo.item_cooccurrence(_df(spark, rows), block_items=16)
    big = mo.item_cooccurrence(_df(spark, rows), block_items=100000)
    assert small.count() == 300 * 299 // 2
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, big.collect()))


def test_item_cf_scores(spark):
    items, c = _brute_cos(CF_TINY)
    df = _df(spark, CF_TINY)
    recs = mo.recommend_item_cf(df, mo.item_cosine(df), 10).collect()
    seen = {}
    for u, i in CF_TINY:
        seen.setdefault(u, set()).add(i)
    for r in recs:
        assert r["product_id"] not in seen[r["customer_unique_id"]]
        want = sum(c[items.index(s), items.index(r["product_id"])] for s in seen[r["customer_unique_id"]])
        assert r["score"] == pytest.approx(want, abs=1e-8)
    # user 3 (item 3) gets 1, 2 and 4 — all co-bought with 3
    assert {r["product_id"] for r in recs if r["customer_unique_id"] == 3} == {1, 2, 4}


def test_svd_scores_match_numpy(spark):
    rng = np.random.default_rng(3)
    x = (rng.random((10, 6)) < 0.5).astype(float)
    x[0, :] = 1
    x[:, 0] = 1
    rows = [(u, i) for u in range(10) for i in range(6) if x[u, i]]
    model = fa.fit_svd(_df(spark, rows), n_components=3)
    _, s, vt = np.linalg.svd(x)
    assert model.singular_values == pytest.approx(s[:3], rel=1e-8)
    v = vt[:3].T
    want = x @ v @ v.T
    got = {r["customer_unique_id"]: np.array(r["factors"]) for r in model.user_factors.collect()}
    for u in range(10):
        assert got[u] @ _items(model).T == pytest.approx(want[u], abs=1e-8)


def test_negative_samples_never_seen_and_exact_count(spark):
    rows = [(u, i) for u in range(20) for i in range(0, 30, (u % 5) + 1)] + [(21, i) for i in range(29)]
    df = _df(spark, rows)
    negs = sa.sample_negatives(df, df.select("product_id").distinct(), df, 5, seed=7)
    got = negs.collect()
    seen = set(rows)
    # users 0, 5, 10, 15 have seen the whole catalogue: no negative exists for them
    full = {u for u in range(20) if u % 5 == 0}
    assert len(got) == sum(1 for u, _ in rows if u not in full) * 5
    assert not any(r["customer_unique_id"] in full for r in got)
    assert all((r["customer_unique_id"], r["neg_item"]) not in seen for r in got)
    per = negs.groupBy("customer_unique_id", "product_id").agg(F.count("*").alias("n"), F.countDistinct("j").alias("nj")).collect()
    assert all(r["n"] == 5 and r["nj"] == 5 for r in per)
    # user 21 has one unseen item: all five draws (with replacement) are that item
    assert {r["neg_item"] for r in got if r["customer_unique_id"] == 21} == {29}


def test_popularity_ties_by_id(spark):
    df = _df(spark, [(1, 5), (2, 5), (1, 3), (2, 3), (3, 9)])
    top = [r["product_id"] for r in mo.popularity(df, 2).orderBy("rank").collect()]
    assert top == [3, 5]


def _items(model):
    rows = sorted(model.item_factors.collect(), key=lambda r: r["product_id"])
    return np.array([r["factors"] for r in rows])


def test_svd_of_fewer_columns_than_items_matches_numpy(spark):
    """A sketch narrower than the catalogue, on a matrix whose spectrum falls off."""
    rng = np.random.default_rng(8)
    group = rng.integers(0, 3, 80)
    rows = [(u, i) for u in range(80) for i in range(40) if i % 3 == group[u] or (u * 31 + i * 17) % 97 == 0]
    x = np.zeros((80, 40))
    for u, i in rows:
        x[u, i] = 1
    model = fa.fit_svd(_df(spark, rows), n_components=3, oversample=5, power_iters=3)
    _, s, vt = np.linalg.svd(x)
    assert model.singular_values == pytest.approx(s[:3], rel=1e-4)
    got = {r["customer_unique_id"]: np.array(r["factors"]) for r in model.user_factors.collect()}
    want = x @ vt[:3].T @ vt[:3]
    assert np.stack([got[u] for u in range(80)]) @ _items(model).T == pytest.approx(want, abs=2e-2)


def test_equal_scores_go_to_smaller_items(spark):
    """Items 1-29 are alike: of the equal ones the smallest ids come first, in blocks or not."""

    users = spark.createDataFrame([(u, [1.0, 0.5]) for u in range(5)], "customer_unique_id long, factors array<double>")
    items = spark.createDataFrame([(i, [0.25, 0.5]) for i in range(30)], "product_id long, factors array<double>")
    seen = _df(spark, [(u, 0) for u in range(5)] + [(4, 2), (4, 3)])
    for ub, ib in ((1024, 4096), (2, 4)):
        recs = fa.score_topk(fa.FactorModel(items.repartition(3), users, 2), seen, 5, user_block=ub, item_block=ib).collect()
        got = {u: [r["product_id"] for r in sorted(recs, key=lambda r: r["rank"]) if r["customer_unique_id"] == u] for u in range(5)}
        assert got == {0: [1, 2, 3, 4, 5], 1: [1, 2, 3, 4, 5], 2: [1, 2, 3, 4, 5], 3: [1, 2, 3, 4, 5], 4: [1, 4, 5, 6, 7]}


def test_randomized_svd_path_matches_numpy(spark):
    """With width ≥ items the range is exact."""
    rng = np.random.default_rng(5)
    x = (rng.random((12, 6)) < 0.5).astype(float)
    x[0, :] = 1
    rows = [(u, i) for u in range(12) for i in range(6) if x[u, i]]
    model = fa.fit_svd(_df(spark, rows), n_components=3)
    _, s, vt = np.linalg.svd(x)
    assert model.singular_values == pytest.approx(s[:3], rel=1e-6)
    v = vt[:3].T
    assert _items(model) @ _items(model).T == pytest.approx(v @ v.T, abs=1e-6)
    recs = fa.score_topk(model, _df(spark, rows), 2).collect()
    assert all((r["customer_unique_id"], r["product_id"]) not in set(rows) for r in recs)


def test_personalize_shared_skips_seen(spark):
    from recspark.operators import ranking as rk

    scores = spark.createDataFrame([(i, float(10 - i)) for i in range(10)], "product_id long, score double")
    seen = _df(spark, [(1, 0), (1, 1), (1, 5), (2, 3)])
    users = spark.createDataFrame([(1,), (2,), (3,)], "customer_unique_id long")
    got = {}
    for r in rk.personalize_shared(scores, users, seen, 3).collect():
        got.setdefault(r["customer_unique_id"], []).append((r["rank"], r["product_id"]))
    assert [i for _, i in sorted(got[1])] == [2, 3, 4]
    assert [i for _, i in sorted(got[2])] == [0, 1, 2]
    assert [i for _, i in sorted(got[3])] == [0, 1, 2]


def test_bpr_loss_matches_formula(spark):
    from recspark.operators import ranking as rk

    d = [0.5, -1.0, 3.0]
    df = spark.createDataFrame([(x, 0.0) for x in d], "pos_score double, neg_score double")
    want = float(np.mean([np.log1p(np.exp(-x)) for x in d]))
    assert rk.bpr_loss(df).first()["bpr_loss"] == pytest.approx(want)


def test_negatives_same_rows_after_repartition(spark):
    rows = [(u, i) for u in range(15) for i in range(0, 40, (u % 4) + 2)]
    df = _df(spark, rows)
    a = sa.sample_negatives(df, df.select("product_id").distinct(), df, 3, seed=11).collect()
    b = sa.sample_negatives(df.repartition(5), df.select("product_id").distinct(), df.repartition(2), 3, seed=11).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_random_lists_are_full_and_distinct(spark):
    users = spark.createDataFrame([(u,) for u in range(200)], "customer_unique_id long")
    for n in (1, 7, 10, 12, 30):
        got = {}
        for r in sa.recommend_random(users, spark.createDataFrame([(i,) for i in range(n)], "product_id long"), 10).collect():
            got.setdefault(r["customer_unique_id"], {})[r["rank"]] = r["product_id"]
        assert len(got) == 200
        assert all(sorted(v) == list(range(1, min(10, n) + 1)) and len(set(v.values())) == len(v) for v in got.values())


def test_negatives_cover_the_unseen_items_evenly(spark):
    rows = [(1, i) for i in (0, 1, 4, 9)] + [(2, i) for i in range(9)]
    negs = sa.sample_negatives(_df(spark, rows), spark.createDataFrame([(i,) for i in range(10)], "product_id long"), _df(spark, rows), 300).collect()
    one = [r["neg_item"] for r in negs if r["customer_unique_id"] == 1]
    assert {x: one.count(x) > 120 for x in set(one)} == {x: True for x in (2, 3, 5, 6, 7, 8)}
    assert {r["neg_item"] for r in negs if r["customer_unique_id"] == 2} == {9}
    full = sa.without_negatives(_df(spark, [(1, 0), (2, 0)]), spark.createDataFrame([(0,), (1,)], "product_id long"), _df(spark, [(1, 0), (2, 0), (2, 1)]))
    assert [r["customer_unique_id"] for r in full.collect()] == [2]


def test_network_scores_over_the_catalogue_equal_the_model(spark):
    from recspark.operators import ranking as rk

    rng = np.random.default_rng(4)
    users = spark.createDataFrame([(u, [float(x) for x in rng.normal(size=2)]) for u in range(6)], "customer_unique_id long, factors array<double>")
    items = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=2)]) for i in range(9)], "product_id long, factors array<double>")
    feats = spark.createDataFrame([(i, *[float(x) for x in rng.normal(size=6)]) for i in range(8)], "product_id long, " + ", ".join(f"{c} double" for c in rk.ITEM_FEATURES))
    model = fa.FactorModel(items, users, 2)
    pairs = spark.createDataFrame([(u, i, float((u + i) % 2)) for u in range(6) for i in range(9)], "customer_unique_id long, candidate long, label double")
    rows, size = rk.mlp_inputs(pairs, model, feats)
    scaler, net = rk.fit_mlp(rows, size, layers=(5, 3), max_iter=20)
    want = {(r["customer_unique_id"], r["candidate"]): r["score"] for r in rk.mlp_score(scaler, net, rows).collect()}
    seen = _df(spark, [(u, u) for u in range(6)])
    got = rk.mlp_recommend(scaler, net, model, feats, seen, seen, 20, user_block=4, item_block=4).collect()
    assert len(got) == 6 * 8
    assert all(abs(want[r["customer_unique_id"], r["product_id"]] - r["score"]) < 1e-8 for r in got)


def test_deep_shared_lists(spark):
    """Users who have seen nothing, the head, scattered positions and almost all."""
    from recspark.operators import ranking as rk

    scores = spark.createDataFrame([(i, float(-i)) for i in range(60)], "product_id long, score double")
    hist = {1: [], 2: range(10), 3: range(0, 60, 2), 4: range(58), 5: range(60), 6: [59]}
    seen = _df(spark, [(u, i) for u, s in hist.items() for i in s])
    users = spark.createDataFrame([(u,) for u in hist], "customer_unique_id long")
    got = {u: [] for u in hist}
    for r in sorted(rk.personalize_shared(scores, users, seen, 4).collect(), key=lambda r: r["rank"]):
        got[r["customer_unique_id"]].append(r["product_id"])
    assert got == {u: [i for i in range(60) if i not in set(s)][:4] for u, s in hist.items()}


def test_class_scores_equal_hand_count(spark):
    from recspark.operators.classify import class_scores

    rows = [(0.0, 0.0)] * 3 + [(0.0, 1.0)] + [(1.0, 1.0)] * 2 + [(1.0, 0.0)] * 2 + [(2.0, 0.0)]
    got = class_scores(spark.createDataFrame(rows, "label double, prediction double"))
    assert got["accuracy"] == pytest.approx(5 / 9)
    assert got["precision_macro"] == pytest.approx((3 / 6 + 2 / 3 + 0) / 3) and got["recall_macro"] == pytest.approx((3 / 4 + 2 / 4 + 0) / 3)
    f = [2 * 0.5 * 0.75 / 1.25, 2 * (2 / 3) * 0.5 / (2 / 3 + 0.5), 0.0]
    assert got["f1_macro"] == pytest.approx(sum(f) / 3) and got["f1_weighted"] == pytest.approx((4 * f[0] + 4 * f[1]) / 9)


def test_negative_samples_of_an_active_user_are_cut(spark):
    """One user has seen most of the catalogue and has most draws: same rows in cuts of 16, groups of bounded size."""
    import random

    from recspark.operators import sampling as sa

    r = random.Random(3)
    items = spark.createDataFrame([(f"p{i:04d}",) for i in range(400)], "product_id string")
    hot = [("hot", f"p{i:04d}") for i in sorted(r.sample(range(400), 370))]
    rows = hot + [("none_left", f"p{i:04d}") for i in range(400)] + [(f"u{u}", f"p{r.randrange(400):04d}") for u in range(30) for _ in range(3)]
    seen = spark.createDataFrame(sorted(set(rows)), "customer_unique_id string, product_id string")
    whole = sorted(tuple(x) for x in sa.sample_negatives(seen, items, seen, 5).collect())
    assert whole == sorted(tuple(x) for x in sa.sample_negatives(seen, items, seen, 5, cut=16).collect())
    own = {}
    for u, i in rows:
        own.setdefault(u, set()).add(i)
    unseen = {u: [f"p{i:04d}" for i in range(400) if f"p{i:04d}" not in s] for u, s in own.items()}
    assert len(whole) == sum(5 * len(s) for u, s in own.items() if u != "none_left")
    assert all(neg in unseen[u] for u, _, neg, _ in whole)
    assert {neg for u, _, neg, _ in whole if u == "hot"} == set(unseen["hot"])
    idx = sa.catalog_index(items)
    both = sa.draws_and_steps(seen, sa._banned(seen, None, idx, "customer_unique_id", "product_id"), 400, 5, 42, "customer_unique_id", "product_id", 16)
    groups = both.groupBy("customer_unique_id", "_part", "_deal").count().collect()
    assert max(g["count"] for g in groups) <= 6 * 16 and sum(g["count"] for g in groups) < 3 * 5 * len(rows)


def test_item_cf_deals_busy_users_over_parts(spark, monkeypatch):
    """Users whose items reach more neighbours than a task takes are dealt over parts by candidate: same lists."""
    rng = np.random.default_rng(8)
    df = _df(spark, sorted({(int(u), int(i)) for u, i in zip(rng.integers(0, 12, 150), rng.integers(0, 40, 150))}))
    sim = mo.item_cosine(df).cache()
    want = sorted(tuple(r) for r in mo.recommend_item_cf(df, sim, 5).collect())
    monkeypatch.setattr(mo, "ROWS_A_TASK", 20)
    got = mo.recommend_item_cf(df, sim, 5)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) == 12 * 5
    sim.unpersist()


def test_light_users_are_drawn_where_they_land(spark):
    """Users with few rows are one group, however large the catalogue is; busy ones are cut."""
    from recspark.operators import sampling as sa

    items = spark.createDataFrame([(i,) for i in range(200)], "product_id long")
    seen = _df(spark, [(1, 3 * i) for i in range(4)] + [(2, i) for i in range(60)])
    idx = sa.catalog_index(items)
    both = sa.draws_and_steps(seen, sa._banned(seen, None, idx, "customer_unique_id", "product_id"), 200, 2, 42, "customer_unique_id", "product_id", 16)
    parts = {r["customer_unique_id"]: r["n"] for r in both.groupBy("customer_unique_id").agg(F.count_distinct("_part").alias("n")).collect()}
    assert parts[1] == 1 and parts[2] > 5
    got = sa.sample_negatives(seen, items, seen, 2, cut=16).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, sa.sample_negatives(seen, items, seen, 2).collect()))
    held = {(r["customer_unique_id"], r["product_id"]) for r in seen.collect()}
    assert len(got) == 128 and all((r["customer_unique_id"], r["neg_item"]) not in held for r in got)


def test_network_screen_keeps_the_exact_best(spark):
    """Rough scores lie within their error, so the walk over blocks finds what double precision finds, ties included."""
    from recspark.operators import ranking as rk
    from recspark.operators.topk import Walk

    rng = np.random.default_rng(5)
    sizes = [(7, 9), (4, 7), (2, 4)]
    net = rk.Network([(rng.normal(size=s) * 2, rng.normal(size=s[0])) for s in sizes], rng.normal(size=9), np.abs(rng.normal(size=9)) + 0.2, 3)
    p, m = rng.normal(size=(40, 3)) * 3, rng.normal(size=(300, 6)) * 3
    m[200:] = m[:100]
    exact = np.array([net.exact(np.repeat(row[None], len(m), 0), m) for row in p])
    rough, off = net.rough(p, m)
    assert (np.abs(rough - np.log(exact / (1 - exact))) <= off[:, None] + 1e-9).all() and off.max() < 0.01
    walk = Walk(p, [np.array([i]) for i in range(40)], np.full((40, 5), -np.inf), np.zeros((40, 5), dtype=np.int64), net)
    for at in range(0, 300, 64):
        walk.block(0.0, np.arange(at, min(at + 64, 300)), m[at:at + 64])
    shown = np.round(exact, 9)
    for i in range(40):
        best = sorted((-s, j) for j, s in enumerate(shown[i]) if j != i)[:5]
        assert walk.r[i].tolist() == [j for _, j in best] and walk.s[i].tolist() == [-s for s, _ in best]
