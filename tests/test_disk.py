"""What loops leave on the disk."""

import os
import time

from pyspark.sql import functions as F

from recspark.operators import factor as fa
from recspark.operators import models as mo
from recspark.operators import topk as tk
from recspark.session import Tables, checkpoint_dir, cut_lineage, drop_checkpoint


def shuffle_files(spark) -> set[str]:
    kept = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return {name for name in map(os.path.basename, kept) if name.startswith("shuffle_")}


def joined(spark):
    sums = spark.range(20000).withColumn("k", F.col("id") % 1000).groupBy("k").agg(F.sum("id").alias("s"))
    return sums.join(spark.range(5000).withColumnRenamed("id", "k").repartition(3, "k"), "k")


def test_checkpoints_and_tables_leave_no_shuffle_files(spark):
    for keep in (cut_lineage, lambda df: Tables(spark).write(df)[0]):
        df, before = joined(spark), shuffle_files(spark)
        kept = keep(df)
        for _ in range(100):  # they go in the background
            if not shuffle_files(spark) - before:
                break
            time.sleep(0.1)
        assert not shuffle_files(spark) - before
        assert kept.count() == 1000
        assert df.count() == 1000  # and the plan still runs


def test_dropped_checkpoints_are_gone(spark):
    df = cut_lineage(joined(spark))
    path = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get().removeprefix("file:")
    assert os.path.isdir(path)
    drop_checkpoint(df)
    assert not os.path.exists(path)


def test_svd_keeps_no_product_of_its_rounds(spark):
    kept = lambda: {f"{r}/{d}" for r, ds, _ in os.walk(checkpoint_dir(spark).removeprefix("file:")) for d in ds if d.startswith("rdd-")}
    rows = spark.createDataFrame([(u, (u * 7 + j * j) % 23) for u in range(60) for j in range(5)], "customer_unique_id long, product_id long")
    before = kept()
    model = fa.fit_svd(rows, 4)
    left = kept() - before
    assert model.user_factors.count() == 60 and model.item_factors.count() == rows.select("product_id").distinct().count()
    assert len(left) <= 7  # two a side for its numbers, tiles, the two sides of the result: cells and each of six products stayed


def test_groups_land_in_a_task_each(spark):
    for n in (1, 2, 7, 32):
        labels = tk.part_labels(spark, n)
        got = spark.createDataFrame([(x,) for x in labels], "part int").repartition(n, "part").select(F.spark_partition_id().alias("p")).distinct().count()
        assert len(labels) == n and got == n


def test_item_cf_in_waves_equals_one_pass(spark, monkeypatch):
    rows = [(None if u == 3 else u, (u * 7 + j * j * (1 + u % 3)) % 29) for u in range(80) for j in range(6)]
    df = spark.createDataFrame(rows + rows[:40], "customer_unique_id long, product_id long")
    sim, made = mo.item_cosine(df), []
    lists = lambda: sorted(map(tuple, mo.recommend_item_cf(df, sim, 5).select("customer_unique_id", "product_id", "score", "rank").collect()), key=str)
    once = lists()
    monkeypatch.setattr(mo, "ROWS_A_WAVE", 3000)
    one = mo._item_cf_lists
    monkeypatch.setattr(mo, "_item_cf_lists", lambda seen, *rest: made.append(seen.count()) or one(seen, *rest))
    got = mo.recommend_item_cf(df, sim, 5)
    assert len(made) > 2 and max(made) < sum(made) == df.distinct().count()
    monkeypatch.setattr(mo, "_item_cf_lists", one)
    assert lists() == once == sorted(map(tuple, got.select("customer_unique_id", "product_id", "score", "rank").collect()), key=str)
    assert len(once) > 300
