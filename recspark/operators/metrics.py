"""Ranking metrics at K, computed from hits only.

A user's list contributes only where it meets the relevant set, so the work is a
join of recommendations with relevant pairs (or, for one shared list, of relevant
pairs with that list on the item — never users × list). Users without any hit add
zeros; they enter through the evaluated-user count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.operators.prepare import ITEM, USER

K_VALUES = (5, 10, 20)
METRICS = ("MAP", "NDCG", "Precision", "Recall", "HitRate")


def ideal_dcg(m: Column) -> Column:
    """Σ_{i=1..m} 1/log2(i+1), evaluated on the JVM."""
    return F.aggregate(
        F.sequence(F.lit(1), F.greatest(m.cast("int"), F.lit(1))),
        F.lit(0.0),
        lambda acc, i: acc + F.when(i <= m, F.lit(1.0) / F.log2(i + F.lit(1))).otherwise(F.lit(0.0)),
    )


def relevant_sets(test: DataFrame, user: str = USER, item: str = ITEM) -> DataFrame:
    return test.select(user, item).distinct()


def users_in_both(train: DataFrame, test: DataFrame, user: str = USER) -> DataFrame:
    return train.select(user).distinct().join(test.select(user).distinct(), user, "left_semi")


def hits_personal(recs: DataFrame, relevant: DataFrame, user: str = USER, item: str = ITEM) -> DataFrame:
    """(user, rank) for each recommended item that is relevant."""
    return recs.select(user, item, "rank").join(relevant, [user, item], "inner").select(user, "rank")


def hits_shared(shared_list: DataFrame, relevant: DataFrame, user: str = USER, item: str = ITEM) -> DataFrame:
    """Same list for everyone: join relevant pairs to the list on the item.

    The list has at most a few dozen rows (its length is the model's K), so it is broadcast.
    """
    return relevant.join(F.broadcast(shared_list.select(item, "rank")), item, "inner").select(user, "rank")


def cum_hits(hits: DataFrame, user: str = USER) -> DataFrame:
    """Running hit count in rank order (for average precision); per user ≤ list length rows."""
    w = Window.partitionBy(user).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    return hits.withColumn("cum_hits", F.count(F.lit(1)).over(w))


def per_user_metrics(hits: DataFrame, eval_users: DataFrame, ks=K_VALUES, user: str = USER) -> DataFrame:
    """One row per evaluated user with every metric at every k.

    ``eval_users`` carries ``n_rel`` (size of the relevant set); ``hits`` has (user, rank).
    """
    h = cum_hits(hits.join(eval_users.select(user), user, "left_semi"), user)
    aggs = [F.count(F.lit(1)).alias("h_all")]
    for k in ks:
        inside = F.col("rank") <= k
        aggs += [
            F.count_if(inside).alias(f"h_{k}"),
            F.sum(F.when(inside, F.col("cum_hits") / F.col("rank")).otherwise(0.0)).alias(f"ap_{k}"),
            F.sum(F.when(inside, F.lit(1.0) / F.log2(F.col("rank") + 1)).otherwise(0.0)).alias(f"dcg_{k}"),
        ]
    per = h.groupBy(user).agg(*aggs)
    u = eval_users.join(per, user, "left").na.fill(0)
    cols = [F.col(user), F.col("n_rel")]
    for k in ks:
        hk, nrel = F.col(f"h_{k}"), F.col("n_rel")
        cols += [
            F.when(hk > 0, 1.0).otherwise(0.0).alias(f"HitRate@{k}"),
            (hk / F.lit(float(k))).alias(f"Precision@{k}"),
            F.when(nrel > 0, hk / nrel).otherwise(0.0).alias(f"Recall@{k}"),
            F.when(nrel > 0, F.col(f"ap_{k}") / F.least(nrel, F.lit(k))).otherwise(0.0).alias(f"MAP@{k}"),
            F.when(hk > 0, F.col(f"ap_{k}") / hk).otherwise(0.0).alias(f"MAP_hits@{k}"),
            F.when(nrel > 0, F.col(f"dcg_{k}") / ideal_dcg(F.least(nrel, F.lit(k)))).otherwise(0.0).alias(f"NDCG@{k}"),
            F.when(F.col("h_all") > 0, F.col(f"dcg_{k}") / ideal_dcg(F.least(F.col("h_all"), F.lit(k))))
            .otherwise(0.0)
            .alias(f"NDCG_list@{k}"),
            F.col(f"dcg_{k}").cast("double").alias(f"DCG@{k}"),
        ]
    return u.select(*cols)


ALL_METRICS = ("HitRate", "Precision", "Recall", "MAP", "MAP_hits", "NDCG", "NDCG_list", "DCG")


def mean_metrics(per_user: DataFrame, ks=K_VALUES, metrics=ALL_METRICS) -> DataFrame:
    """Macro mean over users, long form (metric, k, value, n_users)."""
    names = [f"{m}@{k}" for m in metrics for k in ks]
    wide = per_user.agg(F.count(F.lit(1)).alias("n_users"), *[F.avg(F.col(f"`{n}`")).alias(n) for n in names])
    stacked = F.explode(
        F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(k).alias("k"), F.col(f"`{m}@{k}`").alias("value")) for m in metrics for k in ks])
    )
    return wide.select(F.col("n_users"), stacked.alias("r")).select(
        "r.metric", "r.k", F.coalesce(F.col("r.value"), F.lit(0.0)).alias("value"), "n_users"
    )


def eval_users_frame(train: DataFrame, test: DataFrame, user: str = USER, item: str = ITEM) -> DataFrame:
    """Users present in train and test, with the size of their relevant test set."""
    rel = test.groupBy(user).agg(F.count_distinct(item).alias("n_rel"))
    return rel.join(train.select(user).distinct(), user, "left_semi")


def evaluate(
    train: DataFrame,
    test: DataFrame,
    recs: DataFrame,
    ks=K_VALUES,
    shared: bool = False,
    metrics=ALL_METRICS,
    user: str = USER,
    item: str = ITEM,
) -> DataFrame:
    """All metrics at all K in one job; users in both train and test, macro mean.

    ``recs`` is (user, item, rank) — or (item, rank) when ``shared`` (one list for all users).
    Lists are cut at 2·max(K) as in the reference loop.
    """
    cap = 2 * max(ks)
    recs = recs.filter(F.col("rank") <= cap)
    relevant = relevant_sets(test, user, item)
    hits = hits_shared(recs, relevant, user, item) if shared else hits_personal(recs, relevant, user, item)
    per = per_user_metrics(hits, eval_users_frame(train, test, user, item), ks, user)
    return mean_metrics(per, ks, metrics)


def catalog_coverage(recs: DataFrame, catalog: DataFrame, item: str = ITEM) -> DataFrame:
    """Distinct recommended items over distinct catalogue items, in one aggregate (no join)."""
    tagged = recs.select(F.col(item), F.lit(True).alias("_rec")).unionByName(catalog.select(F.col(item), F.lit(False).alias("_rec")))
    out = tagged.agg(
        F.count_distinct(F.when(F.col("_rec"), F.col(item))).alias("n_recommended"),
        F.count_distinct(F.when(~F.col("_rec"), F.col(item))).alias("n_catalog"),
    )
    return out.withColumn("coverage", F.try_divide(F.col("n_recommended").cast("double"), F.col("n_catalog")))


def cold_warm(train: DataFrame, test: DataFrame, user: str = USER) -> DataFrame:
    """Test users split into cold (no train history) and warm, with the cold share."""
    tu = test.select(user).distinct()
    flagged = tu.join(train.select(user).distinct().withColumn("_warm", F.lit(1)), user, "left")
    return flagged.agg(
        F.count(F.lit(1)).alias("n_test_users"),
        F.count_if(F.col("_warm").isNull()).alias("n_cold"),
        F.count_if(F.col("_warm").isNotNull()).alias("n_warm"),
        (F.count_if(F.col("_warm").isNull()) * 100.0 / F.count(F.lit(1))).alias("pct_cold"),
    )


def seen_pairs(*frames: DataFrame, user: str = USER, item: str = ITEM) -> DataFrame:
    """History as distinct (user, item) pairs over several splits."""
    out = frames[0].select(user, item)
    for f in frames[1:]:
        out = out.union(f.select(user, item))
    return out.distinct()


def user_items(df: DataFrame, user: str = USER, item: str = ITEM) -> DataFrame:
    """User → item set, long form: a member per row plus the set size (no per-user arrays)."""
    pairs = df.select(user, item).distinct()
    sizes = pairs.groupBy(user).agg(F.count(F.lit(1)).alias("n_items"))
    return pairs.join(sizes, user)


def lift(candidate: DataFrame, baseline: DataFrame) -> DataFrame:
    """candidate ÷ baseline per (metric, k); null where the baseline is 0."""
    b = baseline.select("metric", "k", F.col("value").alias("baseline"))
    c = candidate.select("metric", "k", "value")
    return c.join(b, ["metric", "k"]).withColumn("lift", F.try_divide(F.col("value"), F.when(F.col("baseline") != 0, F.col("baseline"))))


def split_gaps(train: DataFrame, val: DataFrame, test: DataFrame) -> DataFrame:
    """A metric table per split side by side: train, val, test, train - val and val - test per (metric, k)."""
    side = lambda df, name: df.select("metric", "k", F.col("value").alias(name))
    t = side(train, "train").join(side(val, "val"), ["metric", "k"]).join(side(test, "test"), ["metric", "k"])
    return t.withColumn("train_val_gap", F.col("train") - F.col("val")).withColumn("val_test_gap", F.col("val") - F.col("test"))


def list_contract(recs: DataFrame, served: DataFrame, k: int, user: str, item: str, catalog: DataFrame) -> DataFrame:
    """What holds of any personal top-k over the whole catalogue, whatever the model, as one row.

    ``served`` has the history of the users to serve, ``catalog`` all items.
    Users served, rows, and the numbers of users without exactly min(k, unseen) items, of
    wrong ranks, of items the user has seen, and of scores above the one before.
    """
    seen = served.select(user, item).distinct()
    total = catalog.select(item).distinct().count()
    want = seen.groupBy(user).agg(F.least(F.lit(k), F.lit(total) - F.count("*")).alias("_want"))
    order = Window.partitionBy(user).orderBy("rank")
    marked = recs.withColumn("_pos", F.row_number().over(order)).withColumn("_before", F.lag("score").over(order))
    marked = marked.join(seen.withColumn("_seen", F.lit(1)), [user, item], "left")
    per = marked.groupBy(user).agg(F.count("*").alias("_n"), F.count_if(F.col("_pos") != F.col("rank")).alias("_r"), F.count("_seen").alias("_s"), F.count_if(F.col("score") > F.col("_before")).alias("_u"))
    per = want.join(per, user, "full").na.fill(0)
    return per.agg(F.count_if(F.col("_n") > 0).alias("n_users"), F.sum("_n").alias("n_rows"), F.count_if(F.col("_n") != F.col("_want")).alias("n_short"),
                   F.sum("_r").alias("n_wrong_rank"), F.sum("_s").alias("n_seen"), F.sum("_u").alias("n_rising"))


def eval_counts(train: DataFrame, test: DataFrame, user: str = USER) -> DataFrame:
    c = cold_warm(train, test, user)
    return c.select("n_test_users", F.col("n_warm").alias("n_evaluated"), (F.col("n_cold") / F.col("n_test_users")).alias("cold_start_rate"))


def mean_std(per_user: DataFrame, metric: str, k: int, min_users: int = 30) -> DataFrame:
    """Mean, and sample std only when at least ``min_users`` users were scored."""
    col = F.col(f"`{metric}@{k}`")
    return per_user.agg(
        F.lit(metric).alias("metric"), F.lit(k).alias("k"), F.avg(col).alias("mean"),
        F.when(F.count(F.lit(1)) >= min_users, F.stddev_samp(col)).alias("std"), F.count(F.lit(1)).alias("n_users"),
    )


def segment_metrics(per_user: DataFrame, train: DataFrame, user: str = USER) -> DataFrame:
    """NDCG@10 / HitRate@10 per activity segment (train rows: 1, 2-5, 6+)."""
    act = train.groupBy(user).agg(F.count(F.lit(1)).alias("n_train"))
    seg = F.when(F.col("n_train") == 1, "1").when(F.col("n_train") <= 5, "2-5").otherwise("6+")
    return per_user.join(act, user).groupBy(seg.alias("segment")).agg(
        F.count(F.lit(1)).alias("n_users"), F.avg(F.col("`NDCG@10`")).alias("ndcg_10"), F.avg(F.col("`HitRate@10`")).alias("hit_rate_10")
    )


def recs_inventory(recs: DataFrame) -> DataFrame:
    return recs.groupBy("model", "variant", "k").agg(F.count(F.lit(1)).alias("n_rows"))


def melt(wide: DataFrame, ids, value_cols, var: str = "metric_k", val: str = "value") -> DataFrame:
    return wide.unpivot(ids, [F.col(f"`{c}`").alias(c) for c in value_cols], var, val)
