"""Prepare stage on a hand-made raw dataset (raw_tiny)."""

import datetime as dt

import pytest

from recspark.operators import prepare as pr


@pytest.fixture()
def raw_tiny(spark):
    ts = lambda d: dt.datetime(2018, 1, d, 10)
    orders = spark.createDataFrame(
        [("o1", "c1", "delivered", ts(1)), ("o2", "c1", "delivered", ts(2)), ("o3", "c2", "delivered", ts(3)),
         ("o4", "c3", "canceled", ts(4)), ("o5", "c2", "delivered", ts(5)), ("o6", "c4", "delivered", ts(6))],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz",
    )
    items = spark.createDataFrame(
        [("o1", 1, "p1", 10.0, 1.0), ("o1", 2, "p2", 20.0, 2.0), ("o2", 1, "p1", 12.0, 1.5), ("o3", 1, "p3", 30.0, 3.0),
         ("o4", 1, "p1", 10.0, 1.0), ("o5", 1, "p4", 40.0, 4.0), ("o5", 2, "p4", 41.0, 4.2), ("o6", 1, "p2", 22.0, 2.0),
         ("o6", 2, "p3", 33.0, 3.0)],
        "order_id string, order_item_id int, product_id string, price double, freight_value double",
    )
    customers = spark.createDataFrame([("c1", "u1"), ("c2", "u2"), ("c3", "u3"), ("c4", "u1")], "customer_id string, customer_unique_id string")
    products = spark.createDataFrame([("p1", "toys"), ("p2", None), ("p3", "books"), ("p4", "toys")], "product_id string, product_category_name string")
    reviews = spark.createDataFrame([("o1", 5), ("o3", 4), ("o3", 2), ("o5", None)], "order_id string, review_score int")
    translation = spark.createDataFrame([("toys", "toys_en"), ("books", "books_en")], "product_category_name string, product_category_name_english string")
    payments = spark.createDataFrame(
        [("o1", 1, "credit_card"), ("o3", 1, None), ("o3", 2, "boleto"), ("o5", 1, "voucher"), ("o6", 1, "debit_card")],
        "order_id string, payment_sequential int, payment_type string",
    )
    return {"orders": orders, "items": items, "customers": customers, "products": products,
            "reviews": reviews, "translation": translation, "payments": payments}


def test_interactions_on_raw_tiny(spark, raw_tiny):
    out = {(r["customer_unique_id"], r["product_id"]): r for r in pr.build_interactions(raw_tiny, ("order_id", "order_item_id")).collect()}
    # cancelled order o4 is gone; u1 bought p1 twice (o1, o2) → one row, first price by order
    assert out[("u1", "p1")]["purchase_count"] == 2
    assert out[("u1", "p1")]["price"] == 10.0
    assert out[("u1", "p1")]["review_score"] == 5.0  # o2 has no review: mean skips nulls
    # two reviews on o3 double its rows
    assert out[("u2", "p3")]["purchase_count"] == 2
    assert out[("u2", "p3")]["review_score"] == 3.0
    # null first payment type → next non-null
    assert out[("u2", "p3")]["payment_type"] == "boleto"
    # null category → 'unknown'
    assert out[("u1", "p2")]["product_category_name_english"] == "unknown"
    assert out[("u1", "p2")]["purchase_count"] == 2  # o1 and o6 (customer c4 is the same unique user)
    # o5: review row with null score → has_review 0, two items of p4
    assert out[("u2", "p4")]["has_review"] == 0 and out[("u2", "p4")]["purchase_count"] == 2
    assert ("u3", "p1") not in out


def test_dedup_payments_mixes_rows(spark, raw_tiny):
    d = {r["order_id"]: r for r in pr.dedup_payments(raw_tiny["payments"]).collect()}
    assert d["o3"]["payment_type"] == "boleto" and d["o3"]["payment_sequential"] == 1


def test_validation_report_counts(spark, raw_tiny):
    df = pr.build_interactions(raw_tiny, ("order_id", "order_item_id"))
    r = pr.validation_report(df).first()
    assert r["n_rows"] == df.count()
    assert r["n_users"] == 2


def test_k_core_fixed_point(spark):
    # chain that needs several rounds to settle, and one that empties
    rows = [(f"u{u}", f"p{p}") for u in range(4) for p in range(3)] + [("u9", "p0"), ("u8", "p9"), ("u8", "p8")]
    df = spark.createDataFrame(rows, "customer_unique_id string, product_id string")
    out, stats = pr.k_core(df, 3, 4)
    got = sorted(tuple(r) for r in out.collect())
    assert got == sorted((f"u{u}", f"p{p}") for u in range(4) for p in range(3))
    # fixed point: applying again removes nothing
    again, _ = pr.k_core(out, 3, 4)
    assert again.count() == out.count()
    empty, st = pr.k_core(df, 5, 5)
    assert empty.count() == 0 and st["final_rows"] == 0


def test_k_core_goes_on_to_the_fixed_point(spark):
    """A path of 104 users loses its two ends each round: more than 50 rounds until nothing is left.

    Only the edges of the nodes that just went are read: each at most once from each end.
    """
    rows = [(u, i) for u in range(104) for i in (u, u + 1)]
    df = spark.createDataFrame(rows, "customer_unique_id long, product_id long")
    out, stats = pr.k_core(df, 2, 2, buckets=1 << 16)
    assert out.count() == 0 and stats["final_rows"] == 0 and stats["iterations"] > 50
    assert 0 < stats["edges_read"] <= 2 * stats["edges"]


def test_k_core_equals_plain_rounds(spark):
    """Random rows with repeats, nulls and a hot item against the rounds done row by row."""
    import random
    from collections import Counter

    for seed in range(3):
        r = random.Random(seed)
        rows = [(r.choice([None, *[f"u{int(r.paretovariate(0.7)) % 60}" for _ in range(9)]]), r.choice([None, *[r.randint(0, 40) if r.random() < 0.7 else 0 for _ in range(9)]])) for _ in range(260)]
        left = [x for x in rows if x[0] is not None]
        rounds, before = 0, None
        while before != len(left):
            before, rounds = len(left), rounds + 1
            for side, least in ((0, 4), (1, 5)):
                n = Counter(x[side] for x in left)
                left = [x for x in left if x[side] is not None and n[x[side]] >= least]
        df = spark.createDataFrame([(*x, k) for k, x in enumerate(rows)], "customer_unique_id string, product_id long, k long")
        out, stats = pr.k_core(df, 4, 5, buckets=8)
        got = out.collect()
        assert sorted(rows[x["k"]] for x in got) == sorted(left)
        assert len({x["k"] for x in got}) == len(got) == stats["final_rows"]
        assert stats["final_users"] == len({x[0] for x in left}) and stats["final_products"] == len({x[1] for x in left})


def test_k_core_of_no_rows(spark):
    out, stats = pr.k_core(spark.createDataFrame([], "customer_unique_id string, product_id string"), 2, 2)
    assert out.count() == 0 and stats["iterations"] == 1 and stats["final_users"] == 0


def test_order_lines_meet_products_while_narrow(spark):
    """Products join the lines before the orders do; columns and rows stand as the joins one after the other leave them."""
    t = {
        "orders": spark.createDataFrame([(1, 10, "F"), (2, 11, "F"), (2, 11, "O"), (3, None, "F")], "order_id long, customer_id long, order_status string"),
        "items": spark.createDataFrame([(1, 5, 1.0), (2, 6, 2.0), (2, 5, 3.0), (2, 9, 4.0), (None, 5, 5.0)], "order_id long, product_id long, price double"),
        "customers": spark.createDataFrame([(10, 100), (11, 110)], "customer_id long, customer_unique_id long"),
        "products": spark.createDataFrame([(5, "a"), (6, None)], "product_id long, product_category_name string"),
        "payments": spark.createDataFrame([(1, 1, "card"), (2, 2, "cash"), (2, 1, None)], "order_id long, payment_sequential int, payment_type string"),
    }
    want = pr.join_products(pr.join_customers(pr.join_payments_left(pr.join_orders_items(t["orders"], t["items"]), t["payments"]), t["customers"]), t["products"])
    for few in (False, True):
        got = pr.merge_tables(t, few_orders=few)
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
