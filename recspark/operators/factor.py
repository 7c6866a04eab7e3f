"""Latent-factor recommenders: truncated SVD of the interaction matrix and implicit ALS.

Both factor tables stay distributed and both models end in the same bounded scorer
(``topk``). One path at every size; only width × width matrices reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.operators import tiles, topk
from recspark.operators.models import interaction_counts
from recspark.operators.prepare import ITEM, USER
from recspark.session import cut_lineage, drop_checkpoint

BROADCAST_BYTES = 64 << 20  # a measured side up to this size is broadcast, a larger one is joined by shuffle


@dataclass
class FactorModel:
    item_factors: DataFrame  # (item, factors array<double>)
    user_factors: DataFrame  # (user, factors array<double>)
    rank: int
    singular_values: np.ndarray | None = None


def _small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def _orthonormal(blocks: DataFrame, width: int) -> tuple[DataFrame, int]:
    """Rows turned into an orthonormal basis of their columns (Gram eigenvectors), and its size."""
    lam, w = np.linalg.eigh(tiles.gram(blocks, width))
    keep = lam > max(lam.max(), 0.0) * 1e-12
    if not keep.any():
        keep[-1] = True
    return tiles.times(blocks, w[:, keep] / np.sqrt(np.maximum(lam[keep], 1e-300))), int(keep.sum())


def fit_svd(train: DataFrame, n_components: int = 50, user: str = USER, item: str = ITEM,
            oversample: int = 10, power_iters: int = 2, seed: int = 42, block: int | None = None) -> FactorModel:
    """Truncated SVD of X (users × items, cell = row count) by a randomized range finder.

    Q spans X·Ω after ``power_iters`` rounds of XᵀQ and XZ; B = QᵀX stays distributed by
    item, B Bᵀ (width²) gives the singular values and rotates B into V; user factors are
    X·V. With as many columns as items the range is whole and the result exact. All products
    run on a grid of tiles (``tiles``), ``block`` users by ``block`` items each.
    """
    cells = cut_lineage(interaction_counts(train, user, item).select(user, item, F.col("v").cast("double").alias("v")))
    x = tiles.tiled(cells, user, item, block)
    drop_checkpoint(cells)
    rank = max(1, min(n_components, x.count["i"] - 1))
    width = max(1, min(x.count["i"], rank + oversample))
    z, w, old = tiles.gaussian(x, "i", width, seed), width, None
    for _ in range(power_iters + 1):
        y = tiles.product(x, z, "u", w)
        q, n = _orthonormal(y, w)
        if old is not None:
            drop_checkpoint(old)
        z, w = tiles.product(x, q, "i", n), n
        drop_checkpoint(y)
        old = z
    lam, u = np.linalg.eigh(tiles.gram(z, w))
    order = np.argsort(lam)[::-1][:rank]
    order = order[lam[order] > max(lam.max(), 0.0) * 1e-12] if lam.max() > 0 else order[:1]
    sv = np.sqrt(np.maximum(lam[order], 1e-300))
    v = cut_lineage(tiles.times(z, u[:, order] / sv))
    drop_checkpoint(z)
    users = tiles.product(x, v, "u", len(order))
    return FactorModel(tiles.rows_of(x, v, "i", len(order), "factors").select(item, "factors"), tiles.rows_of(x, users, "u", len(order), "factors").select(user, "factors"), len(order), sv)


def score_topk(model: FactorModel, train: DataFrame, k: int, user: str = USER, item: str = ITEM, **bounds) -> DataFrame:
    """Top k unseen items per user by factors · item factors, see ``topk.score_topk``."""
    return topk.score_topk(model.user_factors, model.item_factors, train, k, user, item, **bounds)


def score_blocks(model: FactorModel, train: DataFrame, k: int, scores, user: str = USER, item: str = ITEM, **bounds) -> DataFrame:
    """``score_topk`` with any function (user rows, item rows) → score matrix, and so without a bound."""
    return topk.score_topk(model.user_factors, model.item_factors, train, k, user, item, scores, **bounds)


def recommend_svd(train: DataFrame, n_components: int = 50, k: int = 10, user: str = USER, item: str = ITEM) -> DataFrame:
    return score_topk(fit_svd(train, n_components, user, item), train, k, user, item)


def als_input(train: DataFrame, user: str = USER, item: str = ITEM) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cells by dense numbers (_u, _i, v) and the numbers of users and items; several fits may share them."""
    from recspark.operators.features import dense_ids

    counts = interaction_counts(train, user, item)
    uid = dense_ids(counts, user, "_u")
    iid = dense_ids(counts, item, "_i")
    return cut_lineage(counts.join(uid, user).join(iid, item).select(F.col("_u").cast("int"), F.col("_i").cast("int"), "v")), uid, iid


def fit_als(train: DataFrame, rank: int = 16, reg: float = 0.1, alpha: float = 1.0, max_iter: int = 10, seed: int = 42,
            user: str = USER, item: str = ITEM, made: tuple[DataFrame, DataFrame, DataFrame] | None = None) -> FactorModel:
    """Implicit-feedback ALS (Spark MLlib) on row counts; dense ids are consecutive ints. ``made``: the input, if there is one."""
    from pyspark.ml.recommendation import ALS

    data, uid, iid = made or als_input(train, user, item)
    als = ALS(rank=rank, regParam=reg, alpha=alpha, maxIter=max_iter, seed=seed, implicitPrefs=True,
              userCol="_u", itemCol="_i", ratingCol="v", coldStartStrategy="drop", nonnegative=False)
    m = als.fit(data)

    def factors(table, ids, dense, key):
        named = ids.select(F.col(dense).cast("int").alias("id"), key)
        return table.join(named, "id").select(key, F.col("features").cast("array<double>").alias("factors"))

    return FactorModel(factors(m.itemFactors, iid, "_i", item), factors(m.userFactors, uid, "_u", user), rank)


def recommend_als(train: DataFrame, k: int = 10, rank: int = 16, reg: float = 0.1, alpha: float = 1.0, seed: int = 42,
                  user: str = USER, item: str = ITEM) -> DataFrame:
    return score_topk(fit_als(train, rank, reg, alpha, seed=seed, user=user, item=item), train, k, user, item)
