import numpy as np
import pytest

from recspark.operators import factor as fa
from recspark.operators import tiles as ti


def matrix(seed=4, users=70, items=45):
    r = np.random.default_rng(seed)
    x = r.integers(1, 4, (users, items)) * (r.random((users, items)) < 0.15 / (1 + np.arange(items) / 9))
    x[0], x[:, 0] = 1, 1
    return x.astype(float)


def frame(spark, x):
    return spark.createDataFrame([(f"u{u}", int(i), float(x[u, i])) for u, i in np.argwhere(x)], "user string, item long, v double").repartition(3)


def dense(spark, t, side, mat):
    """Rows given by key, in blocks by number."""
    key = {"u": lambda k: int(k[1:]), "i": int}[side]
    number = {r["number"]: key(r[0]) for r in t.numbers[side].collect()}
    rows = mat[[number[k] for k in range(len(number))]]
    return spark.createDataFrame([(b, bytearray(rows[b * t.block:(b + 1) * t.block].astype("<f8").tobytes())) for b in range(t.blocks(side))], "block long, mat binary")


@pytest.mark.parametrize("block", [8, 100])
@pytest.mark.parametrize("small", [True, False])
def test_products_equal_numpy(spark, monkeypatch, block, small):
    if not small:
        monkeypatch.setattr(ti, "BROADCAST_BYTES", 0)
    x, r = matrix(), np.random.default_rng(1)
    t = ti.tiled(frame(spark, x), "user", "item", block)
    z, q = r.normal(size=(45, 3)), r.normal(size=(70, 3))
    users = ti.product(t, dense(spark, t, "i", z), "u", 3)
    got = {row["user"]: row["f"] for row in ti.rows_of(t, users, "u", 3, "f").collect()}
    assert np.allclose([got[f"u{u}"] for u in range(70)], x @ z)
    items = ti.product(t, dense(spark, t, "u", q), "i", 3)
    got = {row["item"]: row["f"] for row in ti.rows_of(t, items, "i", 3, "f").collect()}
    assert np.allclose([got[i] for i in range(45)], x.T @ q)
    assert np.allclose(ti.gram(items, 3), (x.T @ q).T @ (x.T @ q))


def test_tiles_hold_every_cell_once_and_rare_ones_are_missing(spark):
    x = matrix()
    t = ti.tiled(frame(spark, x), "user", "item", 8)
    rows = t.cells.collect()
    assert sum(len(r["col"]) // 4 for r in rows) == np.count_nonzero(x)
    assert len({(r["u_block"], r["i_block"]) for r in rows}) == len(rows) < t.blocks("u") * t.blocks("i")
    assert max(len(r["col"]) for r in rows) == max((len(r["col"]) for r in rows if r["u_block"] == 0 and r["i_block"] == 0))


def test_messages_of_a_product_do_not_grow_with_the_cells(spark):
    """What a product shuffles is at most a part per task and block, however many cells a tile has."""
    few, many = matrix(3), np.ones((70, 45))
    for x in (few, many):
        t = ti.tiled(frame(spark, x), "user", "item", 8)
        z = dense(spark, t, "i", np.ones((45, 2)))
        met = t.cells.join(z.withColumnRenamed("block", "i_block"), "i_block").sortWithinPartitions("u_block")
        parts = met.mapInArrow(lambda it: ti._summed(ti._parts(it, False, 2), 8, 70, 2), "block long, mat binary")
        assert parts.count() <= t.blocks("u") * min(t.blocks("i"), met.rdd.getNumPartitions())


def test_block_size():
    assert ti.block_rows(10, 10, 100) == ti.LEAST_BLOCK
    assert ti.block_rows(10**9, 10**8, 10**11) == ti.MOST_BLOCK
    assert ti.block_rows(10**6, 10**6, 10**8) == 1 << 14


def test_svd_on_many_tiles_equals_numpy(spark):
    x = matrix(9, 30, 12)
    df = frame(spark, x).withColumnRenamed("user", "customer_unique_id").withColumnRenamed("item", "product_id")
    df = df.selectExpr("customer_unique_id", "product_id", "explode(sequence(1, cast(v as int))) as n")
    model = fa.fit_svd(df, n_components=4, block=5)
    _, s, vt = np.linalg.svd(x)
    assert model.singular_values == pytest.approx(s[:4], rel=1e-6)
    got = {r[0]: np.array(r["factors"]) for r in model.user_factors.collect()}
    v = np.array([r["factors"] for r in sorted(model.item_factors.collect(), key=lambda r: r[0])])
    assert np.allclose([got[f"u{u}"] @ v.T for u in range(30)], x @ vt[:4].T @ vt[:4], atol=1e-6)


def test_a_large_dense_side_is_not_broadcast(spark, monkeypatch):
    """Spark takes blocks for short rows: without a hint it broadcast random blocks of any size."""
    plans, cut = [], ti.cut_lineage
    t = ti.tiled(frame(spark, matrix()), "user", "item", 8)
    monkeypatch.setattr(ti, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(ti, "cut_lineage", lambda df: plans.append(df._jdf.queryExecution().toString()) or cut(df))
    ti.product(t, ti.gaussian(t, "i", 3, 1), "u", 3)
    assert len(plans) == 1 and "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0].split("== Physical Plan ==")[1]
