import numpy as np

from recspark.operators import factor as fa
from recspark.operators import pairwise as pw
from recspark.operators import ranking as rk
from recspark.operators import sampling as sa


def two_tastes(spark, n=60, items=40):
    """Even users hold even items, odd users odd ones; item 0 and 1 are held by all."""
    r = np.random.default_rng(6)
    rows = sorted({(u, int(i)) for u in range(n) for i in r.choice(np.arange(u % 2, items, 2), 8)} | {(u, i) for u in range(n) for i in (0, 1)})
    return rows, spark.createDataFrame([(f"u{u:02d}", i) for u, i in rows] * 2, "customer_unique_id string, product_id long")


def replay(rows, dim, epochs, rate, reg, spread, seed, blocks):
    """One process, one block after the other."""
    names = sorted({u for u, _ in rows})
    things = np.array(sorted({i for _, i in rows}))
    un, inn = np.arange(len(names)), np.arange(len(things))
    users, items = pw.normals(un, dim, seed) * spread, pw.normals(inn, dim + 1, seed + 1) * spread
    items[:, -1] = 0
    cells = np.array([(names.index(u), int(np.searchsorted(things, i))) for u, i in rows])
    for epoch in range(epochs):
        dealt = pw.item_block(inn, epoch, blocks, seed)
        for turn in range(blocks):
            for ub in range(blocks):
                ib = (ub + turn) % blocks
                own_u, own_i = np.flatnonzero(un % blocks == ub), np.flatnonzero(dealt == ib)
                here = cells[(cells[:, 0] % blocks == ub) & (dealt[cells[:, 1]] == ib)]
                if len(here):
                    users[own_u], items[own_i] = pw.descend(users[own_u], items[own_i], np.searchsorted(own_u, here[:, 0]), np.searchsorted(own_i, here[:, 1]), (seed, epoch, ub, ib), rate, reg)
    return names, things, users, items


def test_equals_sequential_replay(spark):
    rows, df = two_tastes(spark)
    model = pw.fit_pairwise(df.repartition(5), dim=4, epochs=2, blocks=3)
    names, things, users, items = replay(rows, 4, 2, 0.08, 0.005, 0.1, 42, 3)
    got = {x[0]: np.array(x["factors"]) for x in model.user_factors.collect()}
    assert len(got) == len(names) and all(np.allclose(got[f"u{u:02d}"], [*users[k], 1.0], atol=1e-12) for k, u in enumerate(names))
    got = {x[0]: np.array(x["factors"]) for x in model.item_factors.collect()}
    assert len(got) == len(things) and all(np.allclose(got[i], items[k], atol=1e-12) for k, i in enumerate(things.tolist()))


def test_personal_lists_and_loss_below_the_linear_one(spark):
    rows, df = two_tastes(spark)
    model = pw.fit_pairwise(df, dim=8, epochs=20, blocks=2)
    lists = {}
    for x in fa.score_topk(model, df, 5).collect():
        lists.setdefault(int(x.customer_unique_id[1:]), []).append(x.product_id)
    own = [sum(i % 2 == u % 2 for i in v) for u, v in lists.items()]
    assert len({tuple(v) for v in lists.values()}) > 10 and sum(own) > 0.9 * 5 * len(lists)
    triples = sa.sample_negatives(df, df.select("product_id").distinct(), df, 4, seed=3)
    loss = rk.bpr_loss(pw.pair_scores(triples, model)).first()
    assert loss["n_pairs"] == triples.count() and loss["bpr_loss"] < 0.3 < np.log(2)


def test_negatives_are_unseen_and_users_of_all_items_stay():
    users, items = np.ones((2, 3)), np.ones((4, 4))
    u, i = np.array([0, 0, 0, 0, 1]), np.array([0, 1, 2, 3, 2])
    new_u, new_i = pw.descend(users, items, u, i, (1, 0, 0, 0), 0.1, 0.0)
    assert (new_u[0] == 1).all()  # the first user has seen everything: no step
    assert new_i[2, 3] > 1 and new_i[:, 3].sum() == 4


def test_no_cells(spark):
    model = pw.fit_pairwise(spark.createDataFrame([], "customer_unique_id string, product_id long"), epochs=1)
    assert model.user_factors.collect() == model.item_factors.collect() == []


def test_rounds_grow_with_the_square_root_of_the_cells():
    assert pw.blocks_for(150_000, 30_000, 100_000, 500_000) == 2
    assert pw.blocks_for(8_400_000, 2_100_000, 100_000, 500_000) == 10  # a block for each 100,000 cells made 84
    assert pw.blocks_for(1_000, 5_000_000, 100_000, 500_000) == 10


def test_scores_of_pairs_without_factors_are_zero(spark):
    model = fa.FactorModel(spark.createDataFrame([(1, [1.0, 2.0]), (2, [0.5, 1.0])], "product_id long, factors array<double>"),
                           spark.createDataFrame([("a", [2.0, 1.0])], "customer_unique_id string, factors array<double>"), 2)
    t = spark.createDataFrame([("a", 1, 2), ("a", 1, 9), ("a", 9, 2), ("b", 1, 2), ("a", None, 2), ("a", 1, 2)], "customer_unique_id string, product_id long, neg_item long")
    got = sorted(((r[0], r[1] or 0, r[2], r[3], r[4]) for r in pw.pair_scores(t, model).collect()))
    assert got == [("a", 0, 2, 0.0, 2.0), ("a", 1, 2, 4.0, 2.0), ("a", 1, 2, 4.0, 2.0), ("a", 1, 9, 4.0, 0.0), ("a", 9, 2, 0.0, 2.0), ("b", 1, 2, 0.0, 0.0)]


def test_linear_fit_reads_its_triples_as_often_as_one_side(spark):
    """Both rows of a triple come from one reading: a union read every triple twice."""
    n, seen = 200, spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    t = spark.range(n).selectExpr("cast(id % 7 as double) as pos_x", "cast(id % 5 as double) as neg_x").mapInArrow(count, "pos_x double, neg_x double")
    w = rk.fit_bpr_linear(t, cols=["x"], max_iter=5)
    assert w[0] > 0 and seen.value <= 2 * n  # a summary and the training blocks
