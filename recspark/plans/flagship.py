"""Minimum end-to-end slice: interactions → temporal split → popularity → metrics at K."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recspark.operators import metrics, models, prepare, split
from recspark.sources import supplied


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.build_interactions(supplied.raw_tables(spark, sf_dir), order_cols=supplied.ITEM_ORDER, status=supplied.DELIVERED)


def popularity_eval_at_k(spark: SparkSession, sf_dir: str, k: int = 10, ks=(5, 10, 20)) -> DataFrame:
    inter = interactions(spark, sf_dir)
    labelled = split.temporal_split(inter)
    train = split.take_split(labelled, "train")
    test = split.take_split(labelled, "test")
    recs = models.popularity(train, k)
    return metrics.evaluate(train, test, recs, ks=ks, shared=True, metrics=("MAP", "NDCG", "Precision", "Recall", "HitRate"))
