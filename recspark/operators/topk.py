"""Exact top k unseen items per user: items on shelves of falling length, walked until none can rise.

The product of two vectors is at most the product of their lengths. Items are cut into blocks
along falling length; a user's walk ends at the first block whose longest item, times the
user's own length, stays below the user's k-th score so far. The running top k never
leaves the task, so at most k rows a user do. Products are screened in single precision: only
pairs that may be among the best, by the bound on its error, are computed in double.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recspark.operators.models import SCORE_DIGITS
from recspark.session import cut_lineage, freed

SHELF_BYTES, MOST_SHELF = 16 << 20, 8  # items that meet a user at once, in the memory of a task: first so many, then up to 8 times as many
GROUP_BYTES = 64 << 20  # factors and lists of the users of a task
SLACK = 1e-9  # a bound this close to a score may tie with it after rounding


def matrix(col: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def best(scores: np.ndarray, take: int) -> np.ndarray:
    """Positions of the ``take`` largest scores, ties to the earlier position."""
    if take >= len(scores):
        return np.arange(len(scores))
    least = np.partition(scores, len(scores) - take)[len(scores) - take]
    above = np.flatnonzero(scores > least)
    return np.concatenate([above, np.flatnonzero(scores == least)[: take - len(above)]])


def nullable(kind: pa.DataType) -> pa.DataType:
    """A list type whose elements may be null, as Spark's DDL types are."""
    return pa.list_(kind.value_type) if pa.types.is_list(kind) else kind


def _odds(p: np.ndarray) -> np.ndarray:
    """Log odds, rounded down a little; no bound where the share is 0 or less."""
    with np.errstate(divide="ignore", invalid="ignore"):
        z = np.log(p) - np.log1p(-p)
    return np.where(p > 0, z - 1e-6 * (1 + np.abs(z)), -np.inf)


def _share(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(np.minimum(-z, 700)))


class Walk:
    """Running top k of some users. ``met`` counts the (user, block) pairs whose scores were computed."""

    def __init__(self, p: np.ndarray, seen: list[np.ndarray], s: np.ndarray, r: np.ndarray, scores: Callable | None = None):
        self.p, self.s, self.r, self.scores, self.met = p, s, r, scores, 0
        self.length = np.sqrt((p * p).sum(axis=1))
        some = [x for x in seen if len(x)]
        flat = np.concatenate(some) if some else np.zeros(0, dtype=r.dtype)
        order = np.argsort(flat, kind="stable")
        self.seen, self.owner = flat[order], np.repeat(np.arange(len(p)), [len(x) for x in seen])[order]

    def open(self, top: float) -> np.ndarray:
        """Users for whom an item of length ``top`` may still matter; all of them without a bound."""
        if self.scores is not None:
            return np.arange(len(self.p))
        return np.flatnonzero(self.length * top * (1 + SLACK) + SLACK >= self.s[:, -1])

    def _held(self, users: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in ``users`` (rising) and in ``keys`` the pairs are that the users have seen."""
        low, high = (np.searchsorted(self.seen, keys, side) for side in ("left", "right"))
        n = high - low
        at = np.full(len(self.p), -1)
        at[users] = np.arange(len(users))
        row = at[self.owner[np.arange(n.sum()) + np.repeat(low - np.cumsum(n) + n, n)]]
        order = np.argsort(row, kind="stable")
        order = order[np.searchsorted(row[order], 0):]
        return row[order], np.repeat(np.arange(len(keys)), n)[order]

    def block(self, top: float, keys: np.ndarray, mat: np.ndarray, step: int = 512) -> bool:
        """Meet one block, its keys rising; False if no user had to."""
        users, k = self.open(top), self.s.shape[1]
        self.met += len(users)
        if not len(users):
            return False
        seen_row, seen_col = self._held(users, keys)
        # error of a product in single precision: a share of the product of the lengths
        error = self.length * np.sqrt((mat * mat).sum(axis=1).max()) * (mat.shape[1] + 4) * 2.0**-23 if self.scores is None else np.zeros(len(self.p))
        single = self.scores is None and np.isfinite(error).all() and error.max() < 1e20
        right = (mat.astype(np.float32) if single else mat).T
        screen = getattr(self.scores, "rough", None)
        room = np.empty((min(step, len(users)), len(keys)), dtype=right.dtype)
        for at in range(0, len(users), step):
            own = users[at:at + step]
            if screen:
                rough, off = screen(self.p[own], mat)
            else:
                rough, off = self.scores(self.p[own], mat) if self.scores else np.matmul(self.p[own].astype(right.dtype), right, out=room[:len(own)]), error[own]
            low, high = np.searchsorted(seen_row, (at, at + step))
            rough[seen_row[low:high] - at, seen_col[low:high]] = -np.inf
            # from scores to what is screened and back, where these differ
            there, back = (_odds, _share) if screen else (lambda x: x,) * 2
            least = there(self.s[own, -1] - SLACK) - off
            fresh = np.flatnonzero(~np.isfinite(least))
            if len(fresh) and k < len(keys):  # no k items yet: what stays below the k-th best of the block is out
                kth = np.partition(rough[fresh], len(keys) - k, axis=1)[:, len(keys) - k]
                least[fresh] = np.where(np.isfinite(kth), there(back(kth - off[fresh]) - SLACK) - off[fresh], -np.inf)
            least = np.maximum(least, -1e300 if rough.dtype == np.float64 else -3e38)
            if rough.dtype == np.float32:  # rounded down, so that no pair is lost
                least = np.nextafter(least.astype(np.float32), np.float32(-np.inf))
                least = np.maximum(least, np.float32(-3e38))
            hits = np.flatnonzero(rough >= least[:, None])
            if not len(hits):
                continue
            row, col = np.divmod(hits, len(keys))
            many = np.flatnonzero(np.bincount(row, minlength=len(own)) > 4 * k)
            if len(many):  # ties, mostly: the best k of each
                few = ~np.isin(row, many)
                lists = []
                for x in many.tolist():
                    open_ = np.flatnonzero(np.isfinite(rough[x]))
                    lists.append(open_[best(self._exact(own, np.full(len(open_), x), open_, rough, mat), k)])
                row = np.concatenate([row[few], np.repeat(many, [len(x) for x in lists])])
                col = np.concatenate([col[few], *lists])
                order = np.argsort(row, kind="stable")
                row, col = row[order], col[order]
            score = self._exact(own, row, col, rough, mat)
            rows, first, n = np.unique(row, return_index=True, return_counts=True)
            place, width = np.arange(len(row)) - np.repeat(first, n), n.max()
            new_s, new_r = np.full((len(rows), width), -np.inf), np.zeros((len(rows), width), dtype=np.promote_types(self.r.dtype, keys.dtype))
            line = np.repeat(np.arange(len(rows)), n)
            new_s[line, place], new_r[line, place] = score, keys[col]
            both_s = np.concatenate([self.s[own[rows]], new_s], axis=1)
            both_r = np.concatenate([self.r[own[rows]], new_r], axis=1)
            order = np.lexsort((both_r, -both_s), axis=1)[:, :k]
            if self.r.dtype != both_r.dtype:
                self.r = self.r.astype(both_r.dtype)
            self.s[own[rows]], self.r[own[rows]] = np.take_along_axis(both_s, order, axis=1), np.take_along_axis(both_r, order, axis=1)
        return True

    def _exact(self, own: np.ndarray, row: np.ndarray, col: np.ndarray, rough: np.ndarray, mat: np.ndarray) -> np.ndarray:
        """Rounded scores of pairs (row of ``own``, column)."""
        if self.scores is None:
            return np.round(np.einsum("ij,ij->i", self.p[own[row]], mat[col]), SCORE_DIGITS)
        return np.round(self.scores.exact(self.p[own[row]], mat[col]) if hasattr(self.scores, "exact") else rough[row, col], SCORE_DIGITS)


def part_labels(spark, n: int) -> list[int]:
    """``n`` numbers that a shuffle into ``n`` partitions deals to one each."""
    found, at = {}, 0
    while len(found) < n:
        more = spark.range(at, at + 64 * n).select(F.col("id").cast("int").alias("id")).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("to"))
        for r in more.groupBy("to").agg(F.min("id").alias("id")).collect():
            found.setdefault(r["to"], r["id"])
        at += 64 * n
    return [found[x] for x in range(n)]


def _blocks(items: DataFrame, item: str, size: int) -> DataFrame:
    """``block, top, n_bytes, keys, mat``: runs of items of similar length, ``top`` the largest."""
    from pyspark import TaskContext

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for b in batches:
            for part in (b.slice(i, size) for i in range(0, b.num_rows, size)):
                part = part.sort_by(item)
                mat = np.ascontiguousarray(matrix(part.column(1))).astype("<f8").tobytes()
                keys = pa.ListArray.from_arrays(pa.array([0, part.num_rows], type=pa.int32()), part.column(0))
                top = part.column(2).to_numpy().max()
                yield pa.RecordBatch.from_arrays([pa.array([(TaskContext.get().partitionId() << 32) + n]), pa.array([top]), pa.array([len(mat)]), keys, pa.array([mat], type=pa.binary())],
                                                 names=["block", "top", "n_bytes", "keys", "mat"])
                n += 1

    return items.mapInArrow(pack, f"block long, top double, n_bytes long, keys array<{dict(items.dtypes)[item]}>, mat binary")


def score_topk(user_factors: DataFrame, item_factors: DataFrame, train: DataFrame, k: int, user: str, item: str,
               scores: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None, user_block: int | None = None, item_block: int = 2048, shelf_bytes: int = SHELF_BYTES) -> DataFrame:
    """``user, item, score, rank``: the k best items that ``train`` does not hold for the user.

    ``user_factors`` and ``item_factors`` hold one row per key with ``factors``. The score is
    the product of the factors, rounded to 9 digits, ties to the smaller item; or
    ``scores(user rows, item rows)``, which has no bound, so that every block is met. An object with
    ``rough`` log odds of all pairs (and their error) and ``exact`` scores of some is screened like products. Users without
    k unseen items get them all, users without factors none.

    Blocks of items are put on shelves along falling length, the first of ``shelf_bytes``, each
    later one twice as large up to ``MOST_SHELF`` times. A round brings one shelf to every group
    of about ``user_block`` users (by default as many as fill ``GROUP_BYTES``, or a core's
    share) that can still change, and only those go on to the next (through a checkpoint); most
    catalogues are one shelf, which is one round without a checkpoint. A shelf is shuffled once
    a group, so groups are few and large, a task each. Neither side is held whole by a task or the driver.
    """
    kinds = dict(item_factors.dtypes) | {f"u_{c}": t for c, t in user_factors.dtypes}
    length = F.sqrt(F.aggregate("factors", F.lit(0.0), lambda s, x: s + x * x)) if scores is None else F.lit(0.0)
    rows = item_factors.select(item, F.col("factors").cast("array<double>").alias("factors"), length.alias("_len"))
    order = [F.desc("_len"), F.asc(item)]
    blocks = cut_lineage(_blocks(rows.repartitionByRange(*order).sortWithinPartitions(*order), item, item_block))
    upto = Window.orderBy(F.desc("top"), "block").rowsBetween(Window.unboundedPreceding, -1)  # one short row per block
    units = F.coalesce(F.sum("n_bytes").over(upto), F.lit(0)) / F.lit(shelf_bytes)
    small = 2 * MOST_SHELF - 1  # units on the shelves of 1, 2, ... MOST_SHELF
    shelf = F.when(units < small, F.floor(F.log2(units + 1))).otherwise(F.lit(MOST_SHELF.bit_length()) + F.floor((units - small) / MOST_SHELF))
    shelved = blocks.select("block", "top", "n_bytes").withColumn("shelf", shelf)
    with freed(item_factors.sparkSession):
        tops = [(r["shelf"], r["top"]) for r in shelved.groupBy("shelf").agg(F.max("top").alias("top")).orderBy("shelf").collect()]
    numbers = shelved.select("block", "shelf")

    held = train.select(user, item).distinct().groupBy(user).agg(F.sort_array(F.collect_list(item)).alias("seen"))
    users = user_factors.select(user, F.col("factors").cast("array<double>").alias("factors")).join(held, user, "left")
    size = user_factors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("factors")).alias("width")).first()
    user_block = user_block or max(1 << 12, GROUP_BYTES // (8 * ((size["width"] or 0) + 2 * k)))
    cores = user_factors.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(cores, -(-size["n"] // 256)), -(-size["n"] // user_block))
    labels = part_labels(user_factors.sparkSession, parts)
    label = F.get(F.array(*[F.lit(x) for x in labels]), F.pmod(F.xxhash64(user), F.lit(parts)).cast("int"))
    state = users.select(label.alias("part"), user, "factors", "seen", F.lit(None).cast("array<double>").alias("s"), F.lit(None).cast(f"array<{kinds[item]}>").alias("r"))
    schema = f"part int, {user} {kinds['u_' + user]}, factors array<double>, seen array<{kinds[item]}>, s array<double>, r array<{kinds[item]}>, open boolean"

    def meet(after: float | None):
        def run(group: pa.Table, shelf: pa.Table) -> pa.Table:
            if not group.num_rows:
                return pa.table({c: pa.array([], type=nullable(t)) for c, t in zip((*group.column_names, "open"), (*group.schema.types, pa.bool_()))})
            col = {c: group.column(c).combine_chunks() for c in group.column_names}
            n = group.num_rows
            lists = [np.asarray(x) if x else np.zeros(0) for x in col["seen"].to_pylist()]
            shelf = shelf.sort_by([("top", "descending"), ("block", "ascending")])
            keys = [np.array(x) for x in shelf.column("keys").to_pylist()]
            kind = np.result_type(*keys) if keys else np.dtype("int64")
            s, r = np.full((n, k), -np.inf), np.zeros((n, k), dtype=kind)
            for i, (old_s, old_r) in enumerate(zip(col["s"].to_pylist(), col["r"].to_pylist())):
                if old_s:
                    old = np.array(old_r)
                    r = r.astype(np.promote_types(r.dtype, old.dtype))
                    s[i, :len(old_s)], r[i, :len(old_s)] = old_s, old
            walk = Walk(matrix(col["factors"]), lists, s, r, scores)
            for top, own, mat in zip(shelf.column("top").to_pylist(), keys, shelf.column("mat").to_pylist()):
                if not walk.block(top, own, np.frombuffer(mat, dtype="<f8").reshape(len(own), -1)):
                    break
            go_on = np.zeros(n, dtype=bool)
            if after is not None:
                go_on[walk.open(after)] = True
            full = np.isfinite(walk.s)
            off = np.concatenate([[0], np.cumsum(full.sum(axis=1))]).astype(np.int32)
            blank = lambda c: pa.array([x if g else None for x, g in zip(col[c].to_pylist(), go_on)], type=nullable(col[c].type)) if go_on.any() else pa.nulls(n, type=nullable(col[c].type))
            ranked = pa.array(walk.r[full].tolist(), type=col["r"].type.value_type)
            return pa.table({"part": col["part"], user: col[user], "factors": blank("factors"), "seen": blank("seen"), "s": pa.ListArray.from_arrays(off, pa.array(walk.s[full])),
                             "r": pa.ListArray.from_arrays(off, ranked), "open": pa.array(go_on)})

        return run

    done = []
    for j, (shelf, _) in enumerate(tops):
        after = tops[j + 1][1] if j + 1 < len(tops) else None
        here = blocks.join(F.broadcast(numbers.where(F.col("shelf") == shelf)), "block").select(F.explode(F.array(*[F.lit(x) for x in labels])).alias("part"), "block", "top", "keys", "mat")
        out = state.repartition(parts, "part").groupBy("part").cogroup(here.repartition(parts, "part").groupBy("part")).applyInArrow(meet(after), schema)
        if after is None:
            done.append(out.select(user, "r", "s"))
            break
        out = cut_lineage(out)
        done.append(out.where("not open").select(user, "r", "s"))
        state = out.where("open").drop("open")
        if state.isEmpty():
            break
    if not done:  # no items
        done = [state.select(user, "r", "s").where("false")]
    every = done[0]
    for more in done[1:]:
        every = every.union(more)
    listed = every.select(user, F.posexplode(F.arrays_zip("r", "s")).alias("at", "x"))
    return listed.select(user, F.col("x.r").alias(item), F.col("x.s").alias("score"), (F.col("at") + 1).cast("int").alias("rank"))
