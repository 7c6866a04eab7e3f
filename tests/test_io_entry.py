"""Readers, writers, model registry and the driver entry points."""

import json
import os
import tempfile

import pytest

import __spark_entry__ as entry
from recspark.plans import grid
from recspark.sources import files


def test_read_raw_csv_with_junk_headers(spark):
    d = tempfile.mkdtemp(prefix="recspark-csv-", dir="/tmp")
    os.makedirs(f"{d}/raw")
    with open(f"{d}/raw/{files.RAW_FILES['customers']}", "w") as f:
        f.write('"customer_id", \'customer_unique_id\'\nc1,u1\nc2,u2\n')
    t = files.read_raw(spark, d, names=["customers"])
    assert files.resolve_dir(spark, d).endswith("/raw")
    assert sorted(tuple(r) for r in t["customers"].collect()) == [("c1", "u1"), ("c2", "u2")]


def test_load_recs_parses_names(spark):
    d = tempfile.mkdtemp(prefix="recspark-recs-", dir="/tmp")
    for name in ["recommendations_Popularity_all_K10.csv", "recommendations_TopRated_min5_K20.csv"]:
        with open(f"{d}/{name}", "w") as f:
            f.write("product_id\np1\np2\n")
    df = files.load_recs(spark, f"{d}/*.csv")
    got = sorted({(r["model"], r["variant"], r["k"]) for r in df.collect()})
    assert got == [("Popularity", "all", 10), ("TopRated", "min5", 20)]


def test_load_recs_aligns_mixed_headers_and_own_output(spark):
    d = tempfile.mkdtemp(prefix="recspark-recs-", dir="/tmp")
    texts = {"recommendations_Popularity_all_K2.csv": "top_2\np1\np2\n", "recommendations_SVD_n50_K2.csv": "customer_unique_id,product_id,rank\nu1,p3,1\nu1,p4,2\n",
             "recommendations_Other_x_K1.csv": "rank,customer_unique_id,product_id,score\n1,u2,p5,0.5\n"}
    for name, text in texts.items():
        with open(f"{d}/{name}", "w") as f:
            f.write(text)
    got = sorted((r["model"], r["k"], r["customer_unique_id"], r["product_id"], r["rank"]) for r in files.load_recs(spark, f"{d}/*.csv").collect())
    assert got == [("Other", 1, "u2", "p5", 1), ("Popularity", 2, None, "p1", 1), ("Popularity", 2, None, "p2", 2), ("SVD", 2, "u1", "p3", 1), ("SVD", 2, "u1", "p4", 2)]
    recs = spark.createDataFrame([("u1", "p1", 1, "SVD", 10)], "customer_unique_id string, product_id string, rank int, model string, k int")
    files.write_recs(recs, f"{d}/out")
    assert [r.asDict() for r in files.load_recs(spark, f"{d}/out").collect()] == [r.asDict() for r in recs.collect()]


def test_load_runs_sorted(spark):
    d = tempfile.mkdtemp(prefix="recspark-runs-", dir="/tmp")
    for name, run, v in [("a", None, 0.1), ("b", "best", 0.3), ("c", None, 0.2)]:
        with open(f"{d}/metrics_{name}.json", "w") as f:
            json.dump({"baseline": {"NDCG@K": 1 - v}, "test": {"NDCG@K": v, "HitRate@K": v * 2}} | ({"run_name": run} if run else {}), f)
    df = files.load_runs(spark, f"{d}/metrics_*.json")
    assert [(r["run"], r["test.NDCG@K"]) for r in df.collect()] == [("best", 0.3), ("c", 0.2), ("a", 0.1)]
    with pytest.raises(ValueError):
        files.load_runs(spark, f"{d}/metrics_*.json", "test.NDCG@10")


def test_write_splits_partitioned(spark):
    d = tempfile.mkdtemp(prefix="recspark-out-", dir="/tmp")
    df = spark.createDataFrame([(1, "train"), (2, "test")], "x int, split string")
    files.write_splits(df, f"{d}/splits")
    assert {p for p in os.listdir(f"{d}/splits") if p.startswith("split=")} == {"split=test", "split=train"}
    assert spark.read.parquet(f"{d}/splits").count() == 2


def test_model_registry():
    assert "popularity" in grid.list_models()
    with pytest.raises(KeyError):
        grid.get_model("nope")


def test_oracle_keys_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert {r["metric"] for r in rows} == {"MAP", "NDCG", "Precision", "Recall", "HitRate"}


def test_writers_and_shape_checks(spark):
    from recspark.operators import select as se

    d = tempfile.mkdtemp(prefix="recspark-w-", dir="/tmp")
    df = spark.createDataFrame([(1, 10, None), (2, 20, 4.0)], "customer_unique_id long, product_id long, review_score double")
    assert files.write_interactions(df, f"{d}/inter") > 0
    files.write_features(df, f"{d}/feat", {"rows": 2})
    assert spark.read.json(f"{d}/feat_metadata").first()["n_columns"] == 3
    recs = spark.createDataFrame([(1, 10, 0.5, 1, "pop", 10)], "customer_unique_id long, product_id long, score double, rank int, model string, k int")
    files.write_recs(recs, f"{d}/recs")
    assert spark.read.parquet(f"{d}/recs").filter("model = 'pop' AND k = 10").count() == 1
    files.write_id_mappings({"user_id": df.select("customer_unique_id")}, f"{d}/maps")
    assert spark.read.parquet(f"{d}/maps/user_id").count() == 2
    assert se.expect_shape(df, rows=2, cols=3, max_null=2)["nulls"] == 1
    with pytest.raises(se.ShapeError):
        se.expect_shape(df, rows=3)
    with pytest.raises(se.ShapeError):
        se.expect_shape(df, max_null=1)
    diff = se.column_diff(df, df.drop("review_score").withColumn("x", df.product_id))
    assert diff == {"kept": ["customer_unique_id", "product_id"], "new": ["x"], "dropped": ["review_score"]}
