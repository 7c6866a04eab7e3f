"""Seeded draws: negative items, sampled candidate pools, random lists, row samples.

No ``rand()``: every draw is the leading 60 bits of the MD5 of its keys and seed, so
retries and repartitioning reproduce the same rows and any engine can recompute them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.operators.prepare import ITEM, USER
from recspark.session import cut_lineage, sized


#: A row of the catalogue's index, and up to which size it is broadcast.
INDEX_ROW_BYTES, BROADCAST_BYTES = 64, 64 << 20


def draw(*keys: Column, seed: int) -> Column:
    """A 60-bit number from the keys' text and the seed, joined by '|'."""
    text = F.concat_ws("|", *[k.cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def catalog_index(items: DataFrame, item: str = ITEM) -> DataFrame:
    from recspark.operators.features import dense_ids

    return dense_ids(items.select(item).distinct(), item, "_idx")


def sample_negatives(pos: DataFrame, catalog: DataFrame, seen: DataFrame, n: int, seed: int = 42,
                     user: str = USER, item: str = ITEM, exclude: DataFrame | None = None, cut: int = 1 << 16) -> DataFrame:
    """``n`` uniform items per positive (user, item) row, never one the user has seen.

    With replacement: draw j of a pair is a number r below the count of the user's unseen
    items, and means the r-th unseen item in id order. As the user's i-th seen index s_i
    (from 0) has s_i - i unseen ones below it, the r-th unseen index is r plus the number
    of seen indices with s_i - i <= r, a running count over draws and seen indices of the
    user. No rejection, no rounds, no complement. A user who has seen the whole catalogue
    has no negatives: their pairs give no rows (``without_negatives`` lists them); nor do
    pairs of a null user. Returns (user, item, neg_item, j) with j = 0 … n-1.

    A running count never spans a whole user: positions are cut every ``cut`` of them, each
    cut starts from the sum of those before, and a user with more draws than positions has
    them dealt over copies of the seen positions. Copies never outnumber draws and positions.
    """
    idx = cut_lineage(catalog_index(catalog, item))
    n_items = idx.count()
    banned = cut_lineage(_banned(seen, exclude, idx, user, item))
    pairs = pos.select(user, item).distinct()
    both = draws_and_steps(pairs, banned, n_items, n, seed, user, item, cut)
    upto = Window.partitionBy(user, "_part", "_deal").orderBy(F.col("_at"), F.col("_n").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    below = F.sum("_n").over(upto)

    def found(rows: DataFrame, below) -> DataFrame:
        return rows.withColumn("_idx", F.col("_at") + below).where("_n = 0").select(user, item, F.col("j").cast("int"), "_idx")

    picked = found(both.where("not _cut"), below)
    if n_items > cut:
        some = both.where("_cut")
        # copies of a cut hold the same positions, so its first copy has its sum
        sums = some.groupBy(user, "_part").agg(F.sum(F.when(F.col("_deal") == 0, F.col("_n"))).alias("_n"))
        picked = picked.unionByName(found(some.join(_ahead(sums, user), [user, "_part"]), below + F.col("_ahead")))
    else:
        picked = found(both, below)
    items = idx.select("_idx", F.col(item).alias("neg_item"))
    if n_items * INDEX_ROW_BYTES <= BROADCAST_BYTES:
        items = F.broadcast(items)
    else:
        picked = sized(picked, pairs.count() * n, "_idx")
    return picked.join(items, "_idx").select(user, item, "neg_item", "j")


def draws_and_steps(pairs: DataFrame, banned: DataFrame, n_items: int, n: int, seed: int, user: str, item: str, cut: int) -> DataFrame:
    """Draws (``_n`` 0) and seen positions (``_n`` of them at ``_at``) in groups (user, _part, _deal) of bounded size,
    dealt by them. Only users with over ``cut`` rows are cut (``_cut``); the others' pairs are shuffled whole, drawn from where they land."""
    part = lambda c: F.floor(F.col(c) / F.lit(cut))
    cuts = banned.withColumn("_part", part("_idx"))
    counts = cuts.groupBy(user, "_part").agg(F.count(F.lit(1)).alias("_n"))
    inside = F.row_number().over(Window.partitionBy(user, "_part").orderBy("_idx")) - 1
    low = cuts.withColumn("_low", inside).join(_ahead(counts, user), [user, "_part"])
    steps = low.groupBy(user, (F.col("_idx") - F.col("_low") - F.col("_ahead")).alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
    free = counts.groupBy(user).agg((F.lit(n_items) - F.sum("_n")).alias("_free"))
    free = free.withColumn("_held", F.lit(n_items) - F.col("_free"))
    drawn = pairs.groupBy(user).agg((F.count(F.lit(1)) * n).alias("_drawn")).join(free, user, "left")
    users = drawn.select(user, F.coalesce("_free", F.lit(n_items)).alias("_free"), F.coalesce("_held", F.lit(0)).alias("_held"), "_drawn").where("_free > 0")
    users = users.withColumn("_deals", (F.lit(1) + F.floor(F.col("_drawn") / F.greatest(F.lit(cut), "_free"))).cast("int"))
    users = users.withColumn("_cut", F.col("_drawn") + F.col("_held") > cut)
    # written, so that the joins below have a plain side and a user with many rows may be split
    users = cut_lineage(users.select(user, "_free", F.when(F.col("_cut"), F.col("_deals")).otherwise(1).alias("_deals"), "_cut", (F.col("_drawn") + F.col("_held") * F.col("_deals")).alias("_rows")))
    n_rows = users.agg(F.sum("_rows")).first()[0] or 0
    every = F.sequence(F.lit(0), F.lit(n - 1))
    at = F.pmod(draw(F.col(user), F.col(item), F.col("j"), seed=seed), F.col("_free"))
    known = pairs.join(users, user).select(user, item, "_free", "_cut", "_deals", F.explode(F.when(F.col("_cut"), F.transform(every, lambda j: F.array(j))).otherwise(F.array(every))).alias("_js"))
    j = F.get("_js", F.lit(0))
    cut_at = F.when(F.col("_cut"), F.pmod(draw(F.col(user), F.col(item), j, seed=seed), F.col("_free")))
    deal = F.when(F.col("_cut"), F.pmod(F.xxhash64(item, j), "_deals")).otherwise(0).cast("int")
    draws = known.select(user, item, "_js", "_free", "_cut", cut_at.alias("_at"), F.lit(0).cast("long").alias("_n"), deal.alias("_deal"))
    steps = steps.join(users, user).select(user, "_at", "_n", "_cut", F.explode(F.sequence(F.lit(0), F.col("_deals") - 1)).alias("_deal"))
    rows = draws.unionByName(steps, allowMissingColumns=True).withColumn("_part", F.when(F.col("_cut"), part("_at")).otherwise(0))
    rows = sized(rows, n_rows, user, "_part", "_deal").select("*", F.explode_outer("_js").alias("j"))
    return rows.select(user, item, "j", F.coalesce("_at", at).alias("_at"), "_n", "_part", "_deal", "_cut")


def _ahead(sums: DataFrame, user: str) -> DataFrame:
    """``user, _part, _ahead``: the sum of ``_n`` over the user's parts before each (one row a part)."""
    before = Window.partitionBy(user).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(user, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))


def _banned(seen: DataFrame, exclude: DataFrame | None, idx: DataFrame, user: str, item: str) -> DataFrame:
    rows = seen.select(user, item) if exclude is None else seen.select(user, item).union(exclude.select(user, item))
    return rows.distinct().join(idx, item).select(user, "_idx")


def without_negatives(pos: DataFrame, catalog: DataFrame, seen: DataFrame, user: str = USER, item: str = ITEM) -> DataFrame:
    """Users of ``pos`` who have seen every catalogue item."""
    idx = catalog_index(catalog, item)
    full = _banned(seen, None, idx, user, item).groupBy(user).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= F.lit(idx.count()))
    return pos.select(user).distinct().join(full, user, "left_semi")


def sampled_candidates(test: DataFrame, catalog: DataFrame, seen: DataFrame, n_neg: int = 99, seed: int = 42,
                       user: str = USER, item: str = ITEM) -> DataFrame:
    """Per relevant test pair: the positive plus ``n_neg`` negatives outside seen ∪ relevant."""
    rel = test.select(user, item).distinct()
    negs = sample_negatives(rel, catalog, seen, n_neg, seed, user, item, exclude=rel)
    pos = rel.select(user, F.col(item).alias("pos_item"), F.col(item).alias("candidate"), F.lit(1).alias("label"))
    neg = negs.select(user, F.col(item).alias("pos_item"), F.col("neg_item").alias("candidate"), F.lit(0).alias("label"))
    return pos.unionByName(neg)


def recommend_random(users: DataFrame, catalog: DataFrame, k: int = 10, seed: int = 42, user: str = USER, item: str = ITEM) -> DataFrame:
    """min(k, catalogue) distinct random catalogue items per user.

    Position d of a user's list is (a + d * b) modulo the catalogue size, with a start a
    and a stride b drawn for the user; among b and the next numbers the first that shares
    no divisor with the size is taken, so the walk repeats no item before it has met all.
    """
    idx = catalog_index(catalog, item)
    n_items = idx.count()
    take = min(k, n_items)
    if not take:
        return users.select(user).join(idx, F.lit(False)).select(user, item, F.lit(None).cast("double").alias("score"), F.lit(0).alias("rank"))
    start = F.pmod(draw(F.col(user), F.lit("start"), seed=seed), F.lit(n_items))
    strides = coprime_strides(n_items)
    stride = F.element_at(F.array(*[F.lit(s).cast("long") for s in strides]), (F.pmod(draw(F.col(user), F.lit("stride"), seed=seed), F.lit(len(strides))) + 1).cast("int"))
    slots = users.select(user).distinct().select(user, start.alias("_a"), stride.alias("_b"), F.explode(F.sequence(F.lit(0), F.lit(take - 1))).alias("_d"))
    at = slots.select(user, F.pmod(F.col("_a") + F.col("_d") * F.col("_b"), F.lit(n_items)).alias("_idx"), (F.col("_d") + 1).alias("rank"))
    return at.join(idx, "_idx").select(user, item, F.lit(None).cast("double").alias("score"), "rank")


def coprime_strides(n: int, most: int = 64) -> list[int]:
    """Up to ``most`` numbers below n without a common divisor with n, spread over its range."""
    import math

    found, step = [], max(1, n // most)
    for lo in range(1, max(2, n), step):
        s = next((x for x in range(lo, min(lo + step, max(2, n))) if math.gcd(x, n) == 1), None)
        if s is not None:
            found.append(s)
    return found[:most] or [1]


def sample_rows(df: DataFrame, n: int = 2000, seed: int = 42, keys=None) -> DataFrame:
    """Seeded sample of min(n, rows): the n smallest draws of the key columns (the limit is the feature)."""
    keys = keys or df.columns
    h = draw(*[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in keys], seed=seed)
    return df.withColumn("_h", h).orderBy("_h", *keys).limit(n).drop("_h")
