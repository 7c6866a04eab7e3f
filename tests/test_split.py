"""Temporal and random splits: disjoint, complete, ordered, exact sizes, stable."""

import datetime as dt
import math

import pytest

from recspark.operators import split as sp


def _frame(spark, n=101):
    base = dt.datetime(2020, 1, 1)
    rows = [(i % 13, i, "c", base + dt.timedelta(days=i // 4)) for i in range(n)]  # ties on time
    return spark.createDataFrame(rows, "customer_unique_id long, product_id long, product_category_name_english string, order_purchase_timestamp timestamp_ntz")


def test_sizes_order_and_ties(spark):
    df = _frame(spark)
    out = sp.temporal_split(df).collect()
    n = len(out)
    order = sorted(out, key=lambda r: (r["order_purchase_timestamp"], r["customer_unique_id"], r["product_id"]))
    labels = [r["split"] for r in order]
    t, v = math.floor(n * 0.7), math.floor(n * 0.85)
    assert labels == ["train"] * t + ["val"] * (v - t) + ["test"] * (n - v)
    bounds = sp.assert_no_leakage(sp.temporal_split(df))
    assert bounds["train"]["n_rows"] == t


def test_same_result_with_other_partitioning(spark):
    df = _frame(spark)
    a = sorted(tuple(r) for r in sp.temporal_split(df).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        b = sorted(tuple(r) for r in sp.temporal_split(df.repartition(7)).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert a == b


def test_leakage_detected(spark):
    df = spark.createDataFrame(
        [("train", dt.datetime(2020, 1, 5)), ("val", dt.datetime(2020, 1, 2))], "split string, order_purchase_timestamp timestamp_ntz"
    )
    with pytest.raises(sp.LeakageError):
        sp.assert_no_leakage(df)


def test_random_split_exact_sizes_and_deterministic(spark):
    df = _frame(spark, 200)
    a = sp.random_split(df)
    counts = {r["split"]: r["count"] for r in a.groupBy("split").count().collect()}
    # val share of the rest is 0.15 / (1 - 0.7) = 0.49999999999999994 in floats: ⌊60·r⌋ = 29
    assert counts == {"train": 140, "val": 29, "test": 31}
    b = sp.random_split(df.repartition(3))
    assert sorted(tuple(r) for r in a.collect()) == sorted(tuple(r) for r in b.collect())


def test_descending_puts_latest_first(spark):
    df = _frame(spark)
    out = sp.temporal_split(df, descending=True).collect()
    n = len(out)
    order = sorted(out, key=lambda r: (-r["order_purchase_timestamp"].timestamp(), r["customer_unique_id"], r["product_id"]))
    t = math.floor(n * 0.7)
    assert [r["split"] for r in order][:t] == ["train"] * t
    assert {r["split"] for r in order[t:]} <= {"val", "test"}


def test_hot_day_split_is_exact(spark):
    """A third of the rows on one timestamp."""
    base = dt.datetime(2021, 5, 1)
    rows = [(i, i % 50, "c", base) for i in range(300)] + [(1000 + i, i % 50, "c", base + dt.timedelta(hours=i)) for i in range(600)]
    df = spark.createDataFrame(rows, "customer_unique_id long, product_id long, product_category_name_english string, order_purchase_timestamp timestamp_ntz")
    out = sp.temporal_split(df).collect()
    ordered = sorted(out, key=lambda r: (r["order_purchase_timestamp"], r["customer_unique_id"], r["product_id"]))
    n = len(ordered)
    t, v = math.floor(n * 0.7), math.floor(n * 0.85)
    assert [r["split"] for r in ordered] == ["train"] * t + ["val"] * (v - t) + ["test"] * (n - v)


def test_rows_without_a_time_come_last(spark):
    base = dt.datetime(2021, 5, 1)
    rows = [(i, i, "c", base + dt.timedelta(hours=i) if i % 5 == 0 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "customer_unique_id long, product_id long, product_category_name_english string, order_purchase_timestamp timestamp_ntz")
    for descending in (False, True):
        out = sp.temporal_split(df, descending=descending).collect()
        assert sorted(r["split"] for r in out) == ["test"] * 15 + ["train"] * 70 + ["val"] * 15
        assert all(r["split"] == "train" for r in out if r["order_purchase_timestamp"] is not None)
