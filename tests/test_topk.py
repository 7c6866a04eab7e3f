import numpy as np
import pytest

from recspark.operators import topk as tk

SCHEMA_U, SCHEMA_I = "customer_unique_id string, factors array<double>", "product_id string, factors array<double>"


def brute(users, items, seen, k):
    out = {}
    for u, p in users.items():
        rows = sorted((-round(float(np.dot(p, m)), 9), i) for i, m in items.items() if (u, i) not in seen)
        out[u] = [(i, pytest.approx(-s, abs=2e-9)) for s, i in rows[:k]]
    return out


def made(seed=2, n_users=60, n_items=300, width=5):
    r = np.random.default_rng(seed)
    users = {f"u{i}": r.normal(size=width) * r.lognormal() for i in range(n_users)} | {"zero": np.zeros(width)}
    items = {f"i{i:03d}": r.normal(size=width) * r.lognormal(1.0, 1.5) for i in range(n_items)}
    items |= {f"j{i}": items["i000"] for i in range(5)} | {f"z{i}": np.zeros(width) for i in range(3)}
    seen = {(u, i) for u in users for i in items if u != "u1" and r.random() < 0.1} | {("u0", i) for i in items} | {("u1", i) for i in items if i not in ("i005", "z1")}
    return users, items, seen


def run(spark, users, items, seen, k, **bounds):
    frame = lambda rows, schema: spark.createDataFrame([(a, [float(x) for x in b]) for a, b in rows.items()], schema).repartition(3)
    train = spark.createDataFrame(sorted(seen), "customer_unique_id string, product_id string")
    got = {}
    for x in tk.score_topk(frame(users, SCHEMA_U), frame(items, SCHEMA_I), train.union(train), k, "customer_unique_id", "product_id", **bounds).collect():
        got.setdefault(x.customer_unique_id, []).append((x["rank"], x.product_id, x.score))
    return {u: [(i, s) for _, i, s in sorted(v)] for u, v in got.items()}, got


def test_equals_brute_force_in_one_round_and_in_many(spark):
    users, items, seen = made()
    want = {u: v for u, v in brute(users, items, seen, 7).items() if v}
    for bounds in ({}, {"item_block": 20, "shelf_bytes": 3000, "user_block": 9}):
        lists, raw = run(spark, users, items, seen, 7, **bounds)
        assert lists == want and "u0" not in lists and len(lists["u1"]) == 2
        assert all(sorted(x[0] for x in v) == list(range(1, len(v) + 1)) for v in raw.values())


def test_function_instead_of_product(spark):
    users, items, seen = made(3, 12, 50)
    lists, _ = run(spark, users, items, seen, 4, scores=lambda p, m: -((p[:, None, :] - m[None]) ** 2).sum(axis=2), item_block=11, shelf_bytes=900)
    want = {}
    for u, p in users.items():
        rows = sorted((-round(-float(((p - m) ** 2).sum()), 9), i) for i, m in items.items() if (u, i) not in seen)[:4]
        if rows:
            want[u] = [(i, pytest.approx(-s, abs=2e-9)) for s, i in rows]
    assert lists == want


def test_no_items(spark):
    users, _, _ = made()
    assert run(spark, users, {}, {("u0", "x")}, 3)[0] == {}


def walked(lengths, k=10, n_users=40, width=8):
    r = np.random.default_rng(1)
    items = r.normal(size=(len(lengths), width))
    items *= (lengths / np.linalg.norm(items, axis=1))[:, None]
    order = np.argsort(-lengths, kind="stable")
    p = r.normal(size=(n_users, width))
    walk = tk.Walk(p, [np.zeros(0)] * n_users, np.full((n_users, k), -np.inf), np.zeros((n_users, k), dtype=np.int64))
    for at in range(0, len(order), 100):
        own = np.sort(order[at:at + 100])
        if not walk.block(lengths[own].max(), own, items[own]):
            break
    assert (walk.r == [np.lexsort((np.arange(len(items)), -np.round(items @ u, 9)))[:k] for u in p]).all()
    return walk.met / (n_users * -(-len(lengths) // 100))


def test_blocks_that_cannot_matter_are_skipped():
    """Of 100 blocks: lengths as of popular and rare items leave few to meet, equal lengths all."""
    assert walked(np.random.default_rng(5).lognormal(0, 1.5, 10_000)) < 0.05
    assert walked(np.ones(10_000)) == 1.0


def test_pairs_closer_than_single_precision_are_ranked_in_double():
    r = np.random.default_rng(8)
    items = np.ones((3000, 6)) + r.normal(size=(3000, 6)) * 1e-8
    p = np.abs(r.normal(size=(700, 6))) + 0.5
    walk = tk.Walk(p, [np.arange(i % 4) for i in range(700)], np.full((700, 5), -np.inf), np.zeros((700, 5), dtype=np.int64))
    for at in range(0, 3000, 500):
        walk.block(3.0, np.arange(at, at + 500), items[at:at + 500])
    for i, u in enumerate(p):
        score = np.round(np.einsum("j,ij->i", u, items), 9)
        score[:i % 4] = -np.inf
        best = np.lexsort((np.arange(3000), -score))[:5]
        assert np.allclose(walk.s[i], score[best], rtol=0, atol=2e-9)


def test_shelves_grow_and_are_sent_to_few_groups(spark, monkeypatch):
    """A shelf is shuffled once a group: 3,000 users were as many groups as there are shuffle partitions."""
    sent, cut = [], tk.cut_lineage
    monkeypatch.setattr(tk, "cut_lineage", lambda df: sent.append(cut(df)) or sent[-1])
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    users, items = {f"u{i}": np.ones(2) for i in range(300)}, {f"i{i:03d}": np.ones(2) * (1 + i) for i in range(40)}
    lists, _ = run(spark, users, items, {("u0", "i039")}, 3, item_block=4, shelf_bytes=64)
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert {tuple(i for i, _ in v) for u, v in lists.items() if u != "u0"} == {("i039", "i038", "i037")} and [i for i, _ in lists["u0"]] == ["i038", "i037", "i036"]
    rounds = sent[1:]
    assert max(df.select("part").distinct().count() for df in rounds) <= 2
