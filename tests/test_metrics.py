"""Ranking metrics against a direct per-user computation on hand-made lists."""

import math

import pytest
from pyspark.sql import functions as F

from recspark.operators import metrics as me


def brute(recs, rel, k):
    top = recs[:k]
    hits = [1 if i in rel else 0 for i in top]
    h = sum(hits)
    cum, ap = 0, 0.0
    for pos, x in enumerate(hits):
        if x:
            cum += 1
            ap += cum / (pos + 1)
    dcg = sum(x / math.log2(p + 2) for p, x in enumerate(hits))
    idcg = sum(1 / math.log2(p + 2) for p in range(min(len(rel), k)))
    h_all = sum(1 for i in recs if i in rel)
    idcg_list = sum(1 / math.log2(p + 2) for p in range(min(h_all, k)))
    return {
        "HitRate": 1.0 if h else 0.0,
        "Precision": h / k,
        "Recall": h / len(rel) if rel else 0.0,
        "MAP": ap / min(len(rel), k) if rel else 0.0,
        "MAP_hits": ap / h if h else 0.0,
        "NDCG": dcg / idcg if idcg else 0.0,
        "NDCG_list": dcg / idcg_list if idcg_list else 0.0,
        "DCG": dcg,
    }


# metrics_tiny: hit at 1, hit at k, no hit, more relevant than k, fewer recs than k, empty list
LISTS = {
    1: ([10, 11, 12, 13], {10}),
    2: ([20, 21, 22, 23], {23, 99}),
    3: ([30, 31], {39}),
    4: ([40, 41, 42, 43, 44, 45], {40, 42, 44, 45, 46, 47, 48}),
    5: ([], {50}),
}


@pytest.mark.parametrize("k", [1, 2, 4])
def test_per_user_metrics_match_direct_definitions(spark, k):
    recs = [(u, item, r + 1) for u, (lst, _) in LISTS.items() for r, item in enumerate(lst)]
    rel = [(u, i) for u, (_, s) in LISTS.items() for i in s]
    recs_df = spark.createDataFrame(recs or [(0, 0, 1)], "customer_unique_id long, product_id long, rank int")
    rel_df = spark.createDataFrame(rel, "customer_unique_id long, product_id long")
    eu = rel_df.groupBy("customer_unique_id").agg(F.count("*").alias("n_rel"))
    per = me.per_user_metrics(me.hits_personal(recs_df, rel_df), eu, (k,)).collect()
    got = {r["customer_unique_id"]: r for r in per}
    for u, (lst, s) in LISTS.items():
        want = brute(lst, s, k)
        for m, v in want.items():
            assert got[u][f"{m}@{k}"] == pytest.approx(v, abs=1e-12), (u, m)


def test_hand_values_map_and_ndcg(spark):
    # user 2 at k=4: one hit at rank 4, two relevant items
    want = brute([20, 21, 22, 23], {23, 99}, 4)
    assert want["MAP"] == pytest.approx(0.25 / 2)
    assert want["MAP_hits"] == pytest.approx(0.25)
    assert want["NDCG"] == pytest.approx((1 / math.log2(5)) / (1 + 1 / math.log2(3)))
    assert want["NDCG_list"] == pytest.approx(1 / math.log2(5))


def test_shared_list_equals_expanded_list(spark):
    shared = spark.createDataFrame([(10, 1), (23, 2), (31, 3)], "product_id long, rank int")
    rel = spark.createDataFrame([(1, 10), (2, 23), (3, 39)], "customer_unique_id long, product_id long")
    eu = rel.groupBy("customer_unique_id").agg(F.count("*").alias("n_rel"))
    a = me.per_user_metrics(me.hits_shared(shared, rel), eu, (2,)).orderBy("customer_unique_id").collect()
    expanded = spark.createDataFrame([(u, i, r) for u in (1, 2, 3) for i, r in ((10, 1), (23, 2), (31, 3))],
                                     "customer_unique_id long, product_id long, rank int")
    b = me.per_user_metrics(me.hits_personal(expanded, rel), eu, (2,)).orderBy("customer_unique_id").collect()
    assert a == b


def test_catalog_coverage(spark):
    recs = spark.createDataFrame([(1, 1), (2, 1), (2, 3)], "customer_unique_id long, product_id long")
    cat = spark.createDataFrame([(1,), (2,), (3,), (4,)], "product_id long")
    r = me.catalog_coverage(recs, cat).first()
    assert (r["n_recommended"], r["n_catalog"], r["coverage"]) == (2, 4, 0.5)
