"""Recommenders as DataFrame plans: each returns long-form (user, item, score, rank)
or, for the non-personal ones, one shared (item, score, rank) list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recspark.operators.prepare import ITEM, USER
from recspark.session import ROWS_A_TASK, Tables, cut_lineage, drop_checkpoint, freed, sized

#: Contributions that are on the disk at once: more are made in waves of users.
ROWS_A_WAVE = 1 << 28


def topk_per_user(scores: DataFrame, k: int, user: str = USER, item: str = ITEM, score: str = "score") -> DataFrame:
    """Best ``k`` items per user by score, ties by item id; adds 1-based ``rank``.

    Spark plans a per-group limit before the shuffle (WindowGroupLimit), so a user
    with millions of candidates sends at most k rows per map task.
    """
    w = Window.partitionBy(user).orderBy(F.col(score).desc(), F.col(item).asc())
    return scores.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def shared_topk(df: DataFrame, k: int, item: str = ITEM, score: str = "score") -> DataFrame:
    """Global top-k list (TakeOrderedAndProject), then a rank over those k rows only."""
    top = df.orderBy(F.col(score).desc(), F.col(item).asc()).limit(k)
    w = Window.orderBy(F.col(score).desc(), F.col(item).asc())
    return top.withColumn("rank", F.row_number().over(w))


def popularity(train: DataFrame, k: int = 10, item: str = ITEM) -> DataFrame:
    """Items with most rows; the same list for every user, seen items not removed."""
    counts = train.groupBy(item).agg(F.count(F.lit(1)).cast("double").alias("score"))
    return shared_topk(counts, k, item)


def top_rated(train: DataFrame, k: int = 10, min_reviews: int = 5, item: str = ITEM, rating: str = "review_score") -> DataFrame:
    """Best mean rating among items with at least ``min_reviews`` non-null ratings."""
    stats = train.groupBy(item).agg(F.round(F.avg(rating), 9).alias("score"), F.count(rating).alias("n_reviews"))
    return shared_topk(stats.filter(F.col("n_reviews") >= min_reviews), k, item)


def first_per_key(df: DataFrame, key: str, order_cols) -> DataFrame:
    """First row per key under an explicit order (row_number = 1; per-group limit runs map-side)."""
    w = Window.partitionBy(key).orderBy(*[F.col(c) for c in order_cols])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def last_item(df: DataFrame, user: str = USER, item: str = ITEM, ts: str = "order_purchase_timestamp") -> DataFrame:
    """Latest item per user (ties by item id) as one aggregate — no sort of the user's rows."""
    return df.groupBy(user).agg(F.max_by(F.col(item), F.struct(F.col(ts), F.col(item))).alias(item))


# ---------------------------------------------------------------- item-item cosine
def interaction_counts(train: DataFrame, user: str = USER, item: str = ITEM) -> DataFrame:
    """User × item matrix in long form: value = number of rows (duplicates summed)."""
    return train.groupBy(user, item).agg(F.count(F.lit(1)).cast("double").alias("v"))


def item_cooccurrence(train: DataFrame, block_items: int = 512, user: str = USER, item: str = ITEM) -> DataFrame:
    """(item_i, item_j, dot, co_users) for i < j over users holding both.

    Salted self-join: a user's items are hashed into ceil(n_u / block_items) blocks and
    the join key is (user, left block, right block). Every join task therefore sees at
    most block_items² pairs, however many items one user holds; each row is replicated
    once per block of its user (1 for ordinary users). Partial aggregation on the pair
    runs before the shuffle.
    """
    return _blocked_pairs(interaction_counts(train, user, item), block_items, user, item)


def _blocked_pairs(a: DataFrame, block_items: int, user: str, item: str) -> DataFrame:
    """Sums of v·v over users holding both items, from (user, item, v) rows; each block pair once.

    Block pairs are dealt over as many tasks as their number of pairs needs, so a task's table
    of sums stays small."""
    deg = cut_lineage(a.groupBy(user).agg(F.count(F.lit(1)).alias("_n")))
    n_pairs = deg.agg(F.sum(F.col("_n") * (F.col("_n") + 1) / 2)).first()[0] or 0
    nb = F.greatest(F.ceil(F.col("_n") / F.lit(block_items)), F.lit(1)).cast("int")
    a = a.join(deg, user).select(
        user, item, "v", nb.alias("_B"), F.pmod(F.xxhash64(F.col(item)), nb.cast("bigint")).cast("int").alias("_blk")
    )
    left = a.select(user, F.col(item).alias("a"), F.col("v").alias("va"), F.col("_blk").alias("bl"), F.explode(F.sequence(F.col("_blk"), F.col("_B") - 1)).alias("br"))
    right = a.select(user, F.col(item).alias("b"), F.col("v").alias("vb"), F.col("_blk").alias("br"), F.explode(F.sequence(F.lit(0), F.col("_blk"))).alias("bl"))
    key = [user, "bl", "br"]
    pairs = sized(left, n_pairs, *key).join(sized(right, n_pairs, *key), key).filter("bl < br or a < b")
    pairs = pairs.select(F.least("a", "b").alias("item_i"), F.greatest("a", "b").alias("item_j"), (F.col("va") * F.col("vb")).alias("_vv"))
    return sized(pairs, n_pairs, "item_i", "item_j").groupBy("item_i", "item_j").agg(F.sum("_vv").alias("dot"), F.count(F.lit(1)).alias("co_users"))


def item_cosine(train: DataFrame, min_support: int = 1, block_items: int = 512, user: str = USER, item: str = ITEM) -> DataFrame:
    """Cosine between item columns of the user × item count matrix, both directions, no diagonal.

    Columns are scaled to length one first, so a pair's sum is its cosine and the pair
    table is not joined again. ``min_support`` keeps pairs bought together by at least
    that many users (1 = all).
    """
    a = interaction_counts(train, user, item)
    norm = a.groupBy(item).agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))
    unit = a.join(norm, item).select(user, item, (F.col("v") / F.col("norm")).alias("v"))
    half = _blocked_pairs(unit, block_items, user, item).filter(F.col("co_users") >= min_support)
    # both directions from the one computed half (an explode, not a union that would recompute it)
    both = F.explode(F.array(
        F.struct(F.col("item_i").alias("a"), F.col("item_j").alias("b")),
        F.struct(F.col("item_j").alias("a"), F.col("item_i").alias("b")),
    ))
    return half.select(both.alias("p"), F.col("dot").alias("cosine"), "co_users").select(
        F.col("p.a").alias("item_i"), F.col("p.b").alias("item_j"), "cosine", "co_users"
    )


SCORE_DIGITS = 9  # scores equal to 9 decimals are ties (then broken by item id)


def similar_items(sim: DataFrame, k: int = 10) -> DataFrame:
    """Top-k neighbours of every item, self excluded (the pair table has no diagonal)."""
    s = sim.select(F.col("item_i").alias("item"), F.col("item_j").alias("neighbor"), F.round("cosine", SCORE_DIGITS).alias("score"))
    return topk_per_user(s, k, user="item", item="neighbor")


def recommend_item_cf(train: DataFrame, sim: DataFrame, k: int = 10, user: str = USER, item: str = ITEM, users: DataFrame | None = None) -> DataFrame:
    """score(u, c) = Σ cos(i, c) over the user's train items i; seen items dropped; top k.

    With ``users`` only those are scored (an evaluation needs no others).

    Users without history get nothing (no zero-score padding).

    What the users' items add is shuffled once, by user, and summed, freed of seen items and
    cut to the best k where it lands. Users whose items reach very many neighbours are dealt
    over parts by candidate; a part sends its best k. Beyond ``ROWS_A_WAVE`` contributions the users
    come in waves, whose shuffle files go before the next one's are made; the pair table is
    written once for them all.
    """
    rows = train.select(user, item).distinct().withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(user)))
    # an item has at most as many neighbours as its users have items
    reach = rows.groupBy(item).agg(F.sum("_n").alias("_reach"))
    if users is not None:
        rows = rows.join(users.select(user).distinct(), user, "left_semi")
    load = F.sum("_reach").over(Window.partitionBy(user))
    seen = rows.join(reach, item).select(user, item, "_reach", F.ceil(load / F.lit(ROWS_A_TASK)).cast("int").alias("_parts"))
    seen = cut_lineage(seen)
    with freed(seen.sparkSession):
        n_added = seen.agg(F.sum(F.col("_reach") + 1)).first()[0] or 0
    sides = sim.select(F.col("item_i").alias(item), F.col("item_j").alias("_to"), "cosine")
    waves = -(-int(n_added) // ROWS_A_WAVE)
    if waves < 2:
        return _item_cf_lists(seen, sides, n_added, k, user, item)
    tables, lists = Tables(seen.sparkSession), None
    sides, path = tables.write(sides)
    for x in range(waves):
        some = seen.where(F.pmod(F.xxhash64(F.lit("wave"), F.col(user)), F.lit(waves)) == x)
        more, _ = tables.write(_item_cf_lists(some, sides, -(-int(n_added) // waves), k, user, item))
        lists = more if lists is None else lists.unionByName(more)
    tables.drop(path)
    drop_checkpoint(seen)
    return lists


def _item_cf_lists(seen: DataFrame, sides: DataFrame, n_added: int, k: int, user: str, item: str) -> DataFrame:
    """The best ``k`` unseen items of the users of ``seen`` (user, item, _parts) by the neighbours ``sides`` (item, _to, cosine)."""
    added = seen.join(sides, item).select(user, "_parts", "_to", "cosine", F.lit(False).alias("_held"))
    held = seen.where(F.col(user).isNotNull()).select(user, "_parts", F.col(item).alias("_to"), F.lit(None).cast("double").alias("cosine"), F.lit(True).alias("_held"))
    part = F.pmod(F.xxhash64("_to"), F.col("_parts")).cast("int")
    dealt = added.unionByName(held).select(user, part.alias("_part"), F.col("_to").alias(item), "cosine", "_held")
    scores = sized(dealt, n_added, user, "_part").groupBy(user, "_part", item).agg(F.sum("cosine").alias("score"), F.max("_held").alias("_held"))
    scores = scores.where("not _held").select(user, "_part", item, F.round("score", SCORE_DIGITS).alias("score"))
    order = Window.partitionBy(user, "_part").orderBy(F.col("score").desc(), F.col(item).asc())
    best = scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return topk_per_user(best.select(user, item, "score"), k, user, item)


def union_recs(lists) -> DataFrame:
    """Stack (recs, model, variant, k) lists; shared lists lack the user column (null there)."""
    out = None
    for df, model, variant, k in lists:
        d = df.withColumn("model", F.lit(model)).withColumn("variant", F.lit(variant)).withColumn("k", F.lit(k))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def exclude_categories(recs: DataFrame, catalog: DataFrame, categories, item: str = ITEM, cat: str = "product_category_name_english") -> DataFrame:
    """Drop recommended items that belong to any of the given categories."""
    banned = catalog.filter(F.col(cat).isin(list(categories))).select(item).distinct()
    return recs.join(banned, item, "left_anti")


def enrich(recs: DataFrame, train: DataFrame, item: str = ITEM) -> DataFrame:
    """Attach category (first row per item by time, user) and popularity to recommended items."""
    dim = first_per_key(train, item, ["order_purchase_timestamp", USER]).select(item, "product_category_name_english")
    pop = train.groupBy(item).agg(F.count(F.lit(1)).alias("product_popularity"))
    return recs.join(dim.join(pop, item), item, "left")


def dummy_rating(train: DataFrame, test: DataFrame, y: str = "review_score", constant: float = 3.0) -> DataFrame:
    """Mean / median / constant rating predictors scored by RMSE and MAE in one pass over test."""
    from recspark.operators.order import exact_quantiles

    mean = train.agg(F.avg(y)).first()[0]
    median = exact_quantiles(train, y, [0.5])[1][0]
    preds = {"mean": mean, "median": median, "constant": constant}
    t = test.filter(F.col(y).isNotNull())
    aggs = []
    for how, p in preds.items():
        e = F.col(y) - F.lit(p)
        aggs += [F.sqrt(F.avg(e * e)).alias(f"rmse_{how}"), F.avg(F.abs(e)).alias(f"mae_{how}")]
    wide = t.agg(F.count(F.lit(1)).alias("n"), *aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(h).alias("how"), F.col(f"rmse_{h}").alias("rmse"), F.col(f"mae_{h}").alias("mae")) for h in preds]))
    return wide.select("n", rows.alias("r")).select("r.how", "r.rmse", "r.mae", "n")
