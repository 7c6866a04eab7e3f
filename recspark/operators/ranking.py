"""Pairwise and pointwise learned rankers, sampled evaluation, batch scoring, grids.

The single-machine neural trainer of the source is re-aimed at MLlib: a linear
pairwise (BPR) ranker is logistic regression on feature differences, and the
embedding MLP becomes ALS factors + side features → MultilayerPerceptronClassifier.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recspark.operators import metrics as me
from recspark.operators.models import topk_per_user
from recspark.operators.prepare import ITEM, USER
from recspark.session import cut_lineage

ITEM_FEATURES = ["product_popularity", "product_unique_buyers", "product_avg_review_score", "product_avg_price",
                 "product_avg_freight", "product_review_rate"]


def item_feature_table(train: DataFrame, cols=ITEM_FEATURES) -> DataFrame:
    """Per-item side features from train only (no leakage from later splits), nulls → 0."""
    from recspark.operators.features import product_features

    pf = product_features(train)
    return pf.select(ITEM, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])


def bpr_triples(negs: DataFrame, item_feats: DataFrame, cols=ITEM_FEATURES) -> DataFrame:
    """(user, positive, negative) with the features of both items (pos_*, neg_*)."""
    pos = item_feats.select(F.col(ITEM), *[F.col(c).alias(f"pos_{c}") for c in cols])
    neg = item_feats.select(F.col(ITEM).alias("neg_item"), *[F.col(c).alias(f"neg_{c}") for c in cols])
    return negs.join(pos, ITEM).join(neg, "neg_item")


def bpr_loss(scored: DataFrame, pos: str = "pos_score", neg: str = "neg_score") -> DataFrame:
    """mean −ln σ(s⁺ − s⁻), written stably as softplus(−d)."""
    d = F.col(pos) - F.col(neg)
    softplus = F.greatest(-d, F.lit(0.0)) + F.log1p(F.exp(-F.abs(d)))
    return scored.agg(F.avg(softplus).alias("bpr_loss"), F.count(F.lit(1)).alias("n_pairs"))


def fit_bpr_linear(triples: DataFrame, cols=ITEM_FEATURES, reg: float = 0.01, max_iter: int = 50):
    """Linear scorer w·x trained on the BPR loss = logistic regression on x⁺−x⁻ (label 1)
    and the mirrored x⁻−x⁺ (label 0), no intercept. Features are standardised first."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    # both rows of a triple from one reading of it
    side = lambda one, other, label: F.struct(*[(F.col(f"{one}_{c}") - F.col(f"{other}_{c}")).alias(c) for c in cols], F.lit(label).alias("label"))
    rows = triples.select(F.explode(F.array(side("pos", "neg", 1.0), side("neg", "pos", 0.0))).alias("row")).select("row.*")
    data = VectorAssembler(inputCols=list(cols), outputCol="features").transform(rows)
    lr = LogisticRegression(fitIntercept=False, regParam=reg, maxIter=max_iter, standardization=True)
    model = lr.fit(data)
    return [float(w) for w in model.coefficients.toArray()]


def linear_scores(item_feats: DataFrame, weights, cols=ITEM_FEATURES) -> DataFrame:
    score = sum((F.col(c) * F.lit(w) for c, w in zip(cols, weights)), F.lit(0.0))
    return item_feats.select(ITEM, score.alias("score"))


def personalize_shared(item_scores: DataFrame, users: DataFrame, seen: DataFrame, k: int,
                       user: str = USER, item: str = ITEM) -> DataFrame:
    """Top k unseen items per user from one global ranking, without users × catalogue.

    The positions a user needs are found from the positions of their seen items alone:
    k rows a user, no row per candidate.
    """
    from recspark.operators.factor import _small
    from recspark.operators.order import global_index

    # a user's list is the first positions that their seen items don't hold: with the seen
    # positions g_1 < g_2 < ..., the j-th free position is j plus the number of g_i with g_i - i <= j
    ranked = cut_lineage(global_index(item_scores.withColumn("_neg", -F.col("score")), ["_neg", item], "_g").drop("_neg"))
    taken = seen.select(user, item).distinct().join(ranked.select(item, "_g"), item)
    low = F.row_number().over(Window.partitionBy(user).orderBy("_g")) - 1
    steps = taken.select(user, (F.col("_g") - low).alias("_at"), F.lit(1).alias("_held")).where(F.col("_at") < k)
    slots = users.select(user).distinct().select(user, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long"))).alias("_at"), F.lit(0).alias("_held"))
    upto = Window.partitionBy(user).orderBy("_at", F.col("_held").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    free = slots.unionByName(steps).withColumn("_g", F.col("_at") + F.sum("_held").over(upto)).where("_held = 0")
    # most users need positions 0 .. k-1; these k rows are broadcast, only deeper ones are joined by shuffle
    first = free.where(F.col("_g") < 2 * k).join(F.broadcast(ranked.where(F.col("_g") < 2 * k)), "_g")
    deep = free.where(F.col("_g") >= 2 * k).join(_small(ranked.where(F.col("_g") >= 2 * k), ranked.count(), 64), "_g")
    return first.unionByName(deep).select(user, item, "score", (F.col("_at") + 1).cast("int").alias("rank"))


def score_pairs_linear(triples: DataFrame, weights, cols=ITEM_FEATURES) -> DataFrame:
    sp = sum((F.col(f"pos_{c}") * F.lit(w) for c, w in zip(cols, weights)), F.lit(0.0))
    sn = sum((F.col(f"neg_{c}") * F.lit(w) for c, w in zip(cols, weights)), F.lit(0.0))
    return triples.select(USER, ITEM, "neg_item", sp.alias("pos_score"), sn.alias("neg_score"))


# ---------------------------------------------------------------- MLP on factors + side features
def mlp_inputs(pairs: DataFrame, factors, item_feats: DataFrame, use_aux: bool = True, cols=ITEM_FEATURES) -> DataFrame:
    """(user, candidate) rows → feature vector [user factors, item factors, item side features]."""
    from pyspark.ml.functions import array_to_vector

    uf = factors.user_factors.select(USER, F.col("factors").alias("_uf"))
    it = factors.item_factors.select(F.col(ITEM).alias("candidate"), F.col("factors").alias("_if"))
    rank = factors.rank
    df = pairs.join(uf, USER).join(it, "candidate")
    parts = [F.col("_uf"), F.col("_if")]
    if use_aux:
        side = item_feats.select(F.col(ITEM).alias("candidate"), F.array(*[F.col(c) for c in cols]).alias("_side"))
        df = df.join(side, "candidate", "left").withColumn("_side", F.coalesce("_side", F.array(*[F.lit(0.0)] * len(cols))))
        parts.append(F.col("_side"))
    size = 2 * rank + (len(cols) if use_aux else 0)
    return df.withColumn("features", array_to_vector(F.concat(*parts))), size


def fit_mlp(train_pairs: DataFrame, size: int, layers=(64, 32), max_iter: int = 50, seed: int = 42):
    """Scaler and network of the (features, label) rows: MLlib's loss, weights and steps, see ``network``."""
    from recspark.operators.network import train

    return train(train_pairs, [size, *layers, 2], max_iter, seed)


def mlp_score(scaler, model, rows: DataFrame) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    out = model.transform(scaler.transform(rows))
    return out.withColumn("score", vector_to_array("probability")[1])


class Network:
    """The fitted network as matrix products: ``exact`` scores of pairs, and for a whole block of
    items ``rough`` ones in single precision with a bound on their error.

    Rough scores are log odds, which rise with the score; logistic units are run as (1 + tanh(x / 2)) / 2,
    the halves folded into the next layer. The first layer splits into a user's and an item's part.
    """

    def __init__(self, mats, mean: np.ndarray, scale: np.ndarray, rank: int):
        self.mats, self.mean, self.scale, self.rank = mats, mean, scale, rank
        w, bias = mats[0]
        halves = [(w / 2, bias / 2)]
        for j, (w, bias) in enumerate(mats[1:], 2):
            last = j == len(mats)
            if last:  # two classes: only the difference of their outputs counts
                w, bias = w[1:] - w[:1], bias[1:] - bias[:1]
            share = 1.0 if last else 0.5
            halves.append((share * w / 2, share * (bias + w.sum(axis=1) / 2)))
        self.halves = halves

    def _first(self, w: np.ndarray, bias: np.ndarray, p: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        r = self.rank
        return ((p - self.mean[:r]) * self.scale[:r]) @ w[:, :r].T, ((m - self.mean[r:]) * self.scale[r:]) @ w[:, r:].T + bias

    def exact(self, p: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Scores of the pairs (row of ``p``, same row of ``m``) in double precision."""
        left, right = self._first(*self.mats[0], p, m)
        h = left + right
        for w, b in self.mats[1:]:
            h = (1 / (1 + np.exp(-h))) @ w.T + b
        return 1 / (1 + np.exp(h[:, 0] - h[:, 1]))

    def rough(self, p: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log odds of all pairs and, by user, what they may be off by."""
        left, right = self._first(*self.halves[0], p, m)
        out, right32 = np.empty((len(p), len(m)), dtype=np.float32), right.astype(np.float32)
        rest = [(np.ascontiguousarray(w.T, dtype=np.float32), b.astype(np.float32)) for w, b in self.halves[1:]]
        h = np.empty_like(right32)
        for i, row in enumerate(left.astype(np.float32)):
            x = np.add(row, right32, out=h)
            for w, b in rest:
                x = np.tanh(x, out=x) @ w
                x += b
            out[i] = x[:, 0]
        # a unit's error: rounding of its sum, what its inputs are off by, 2^-20 for tanh, whose slope is at most 1
        unit = 2.0**-22
        error = unit * (np.abs(left) + np.abs(right).max(axis=0))
        for w, b in self.halves[1:]:
            error = (error + 2.0**-20) @ np.abs(w).T + unit * (w.shape[1] + 2) * (np.abs(w).sum(axis=1) + np.abs(b))
        return out, error[:, 0]


def mlp_recommend(scaler, model, factors, item_feats: DataFrame, train: DataFrame, users: DataFrame, k: int = 10, use_aux: bool = True, cols=ITEM_FEATURES,
                  **bounds) -> DataFrame:
    """Top k unseen items of the whole catalogue per user by the network's score.

    Users walk all blocks of items; a task runs the network's layers (``Network``) on a user
    against a block in single precision, computes in double those pairs that may be among the
    best k by the bound on its error, and keeps the best k. Ties go to the smaller item.
    """
    from recspark.operators.factor import FactorModel, score_blocks

    layers, weights = list(model.getLayers()), model.weights.toArray()
    mats, at = [], 0
    for a, b in zip(layers, layers[1:]):
        mats.append((weights[at:at + a * b].reshape((b, a), order="F"), weights[at + a * b:at + a * b + b]))
        at += a * b + b
    mean, std = scaler.mean.toArray(), scaler.std.toArray()
    scale = np.divide(1.0, std, out=np.zeros_like(std), where=std > 0)
    side = item_feats.select(ITEM, *[F.col(c).cast("double").alias(c) for c in cols])
    items = factors.item_factors
    if use_aux:
        items = items.join(side, ITEM, "left").select(ITEM, F.concat("factors", F.array(*[F.coalesce(F.col(c), F.lit(0.0)) for c in cols])).alias("factors"))
    known = factors.user_factors.join(users.select(USER).distinct(), USER, "left_semi")
    rank = factors.rank

    return score_blocks(FactorModel(items, known, rank), train, k, Network(mats, mean, scale, rank), **bounds)


# ---------------------------------------------------------------- sampled evaluation
def evaluate_sampled(scored: DataFrame, test: DataFrame, history: DataFrame, k: int = 10, warm_only: bool = True) -> DataFrame:
    """Top k of each user's candidate pool by score → HitRate, Recall, Precision, NDCG, MAP (hits).

    ``scored`` has (user, candidate, score); duplicated candidates keep their best score.
    Only users with history are scored unless ``warm_only`` is False.
    """
    pool = scored.groupBy(USER, F.col("candidate").alias(ITEM)).agg(F.max("score").alias("score"))
    recs = topk_per_user(pool.withColumn("score", F.round("score", 9)), k)
    rel = me.relevant_sets(test)
    eu = test.groupBy(USER).agg(F.count_distinct(ITEM).alias("n_rel"))
    if warm_only:
        eu = eu.join(history.select(USER).distinct(), USER, "left_semi")
    per = me.per_user_metrics(me.hits_personal(recs, rel), eu, (k,))
    return me.mean_metrics(per, (k,), ("HitRate", "Recall", "Precision", "NDCG", "MAP_hits"))


# ---------------------------------------------------------------- batch scoring with fallback
def batch_recommend(users: DataFrame, factors, train: DataFrame, fallback: DataFrame, k: int = 10) -> DataFrame:
    """Known users: factor scores over the whole catalogue, seen dropped, score rounded to 4.
    Unknown users: the fallback (popularity) list."""
    from recspark.operators.factor import score_topk

    known = users.select(USER).distinct().join(factors.user_factors.select(USER), USER, "left_semi")
    sub = replace(factors, user_factors=factors.user_factors.join(known, USER, "left_semi"))
    recs = score_topk(sub, train.join(known, USER, "left_semi"), k).withColumn("score", F.round("score", 4))
    unknown = users.select(USER).distinct().join(factors.user_factors.select(USER), USER, "left_anti")
    fb = fallback.filter(F.col("rank") <= k).select(ITEM, F.round("score", 4).alias("score"), "rank")
    slots = unknown.select(USER, F.explode(F.sequence(F.lit(1), F.lit(k))).alias("rank"))
    cold = slots.join(F.broadcast(fb), "rank").select(USER, ITEM, "score", "rank")
    return recs.select(USER, ITEM, "score", "rank").withColumn("source", F.lit("model")).unionByName(cold.withColumn("source", F.lit("fallback")))
