"""Personal pairwise (BPR) factors by stratified stochastic gradient descent.

Users and items are dealt into as many blocks as there are tasks. In a round each task holds
one user block and one item block, no two tasks share either, and the blocks rotate until
every user block has met every item block: an epoch. Items are dealt anew each epoch, so a
negative, which is drawn from the item block at hand, may be any item in the long run.
Nothing is updated concurrently and every draw is a function of seed, epoch and blocks, so a
retried task gives the same factors and a sequential replay does too.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.operators.factor import FactorModel
from recspark.operators.order import global_index
from recspark.operators.prepare import ITEM, USER
from recspark.session import Tables, cut_lineage, drop_checkpoint

U64 = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64: fixed constants of that generator."""
    x = x + U64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def normals(numbers: np.ndarray, width: int, seed: int) -> np.ndarray:
    """A row of standard normals per number (Box-Muller on hashes): the same wherever it is drawn."""
    cell = _mixed(_mixed(numbers.astype(U64)[:, None] + U64(seed % 2**64)) + np.arange(2 * width, dtype=U64)[None])
    unit = ((cell >> U64(11)).astype(np.float64) + 0.5) / 2.0**53
    return np.sqrt(-2 * np.log(unit[:, :width])) * np.cos(2 * np.pi * unit[:, width:])


def item_block(numbers: np.ndarray, epoch: int, blocks: int, seed: int) -> np.ndarray:
    """The block that each item is dealt to in an epoch."""
    return (_mixed(_mixed(numbers.astype(U64)) + U64((seed * 1_000_003 + epoch) % 2**64)) % U64(blocks)).astype(np.int64)


def descend(users: np.ndarray, items: np.ndarray, u: np.ndarray, i: np.ndarray, draw: tuple[int, int, int, int], rate: float, reg: float, batch: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """One pass over the cells (u, i) of a user and an item block, in an order drawn from ``draw``.

    Rows of ``items`` end with the item's bias. Each cell gets a negative of the block that the
    user has not seen (all of the user's cells with these items are here); a cell whose eight
    draws were all seen is left out of this pass. Steps are taken ``batch`` cells at a time.
    """
    users, items, width = users.copy(), items.copy(), users.shape[1]
    random = np.random.Generator(np.random.Philox(key=[draw[0] % 2**64, (draw[1] << 40) + (draw[2] << 20) + draw[3]]))
    order = random.permutation(len(u))
    u, i = u[order], i[order]
    seen = np.sort(u * len(items) + i)
    j = random.integers(0, max(1, len(items)), len(u))
    for _ in range(7):
        key = u * len(items) + j
        again = np.flatnonzero(seen[np.minimum(np.searchsorted(seen, key), len(seen) - 1)] == key) if len(seen) else np.zeros(0, dtype=np.int64)
        if not len(again):
            break
        j[again] = random.integers(0, len(items), len(again))
    key = u * len(items) + j
    free = np.flatnonzero(seen[np.minimum(np.searchsorted(seen, key), len(seen) - 1)] != key) if len(seen) else np.zeros(0, dtype=np.int64)
    u, i, j = u[free], i[free], j[free]
    for at in range(0, len(u), batch):
        a, p, n = u[at:at + batch], i[at:at + batch], j[at:at + batch]
        own, apart = users[a], items[p] - items[n]
        pull = 1 / (1 + np.exp(np.clip((own * apart[:, :width]).sum(axis=1) + apart[:, width], -500, 500)))[:, None]
        with_bias = np.concatenate([own, np.ones((len(a), 1))], axis=1)
        step_p, step_n = rate * (pull * with_bias - reg * items[p]), rate * (-pull * with_bias - reg * items[n])
        np.add.at(users, a, rate * (pull * apart[:, :width] - reg * own))
        np.add.at(items, p, step_p)
        np.add.at(items, n, step_n)
    return users, items


def blocks_for(cells: int, rows: int, cells_per_task: int, rows_per_block: int) -> int:
    """The least number of blocks whose square deals the cells, and that deals the rows, as wanted."""
    return max(2, math.ceil(math.sqrt(cells / cells_per_task)), -(-rows // rows_per_block))


STATE = "kind int, block long, numbers binary, mat binary"


def _state(kind: int, block: int, numbers: np.ndarray, mat: np.ndarray) -> dict:
    return {"kind": kind, "block": int(block), "numbers": numbers.astype("<i8").tobytes(), "mat": mat.astype("<f8").tobytes()}


def _table(rows: list[dict]) -> pa.Table:
    kinds = {"kind": pa.int32(), "block": pa.int64(), "numbers": pa.binary(), "mat": pa.binary()}
    return pa.table({c: pa.array([r[c] for r in rows], type=t) for c, t in kinds.items()})


def fit_pairwise(train: DataFrame, dim: int = 16, epochs: int = 8, rate: float = 0.08, reg: float = 0.005, spread: float = 0.1, seed: int = 42,
                 blocks: int | None = None, user: str = USER, item: str = ITEM, cells_per_task: int = 100_000, rows_per_block: int = 500_000) -> FactorModel:
    """Factors whose products rank what a user has interacted with above what they have not.

    Minimises the BPR loss -ln sigmoid(s(u, i) - s(u, j)) with s = user · item + bias(item)
    over the distinct cells of ``train``; the bias is the last item factor, its user factor
    is 1. ``blocks`` rounds make an epoch; each round is one job over the blocks, whose result is
    written and read again. A task of a round holds one of blocks x blocks tiles, so by default
    there are as many blocks as give a tile ``cells_per_task`` cells and a block at most
    ``rows_per_block`` users and items: rounds grow with the square root of the cells.
    """
    cells = train.select(user, item).distinct()
    number = {side: cut_lineage(global_index(cells.select(side).distinct(), [side], "number")) for side in (user, item)}
    placed = cut_lineage(cells.join(number[user].withColumnRenamed("number", "u"), user).join(number[item].withColumnRenamed("number", "i"), item).select("u", "i"))
    blocks = blocks or blocks_for(placed.count(), sum(n.count() for n in number.values()), cells_per_task, rows_per_block)

    def first(kind: int, width: int):
        def run(group: pa.Table) -> pa.Table:
            own = np.sort(group.column("number").to_numpy())
            mat = normals(own, width, seed + kind) * spread
            if kind:
                mat[:, -1] = 0.0  # biases
            return _table([_state(kind, group.column("block")[0].as_py(), own, mat)])

        return run

    users = number[user].select("number", (F.col("number") % blocks).alias("block")).groupBy("block").applyInArrow(first(0, dim), STATE)
    items = number[item].select("number", F.lit(0).cast("long").alias("block")).withColumn("block", F.floor(F.col("number") / 65536).cast("long")).groupBy("block").applyInArrow(first(1, dim + 1), STATE)
    tables = Tables(train.sparkSession)
    (users, path), (items, other) = tables.write(users), tables.write(items)
    state = [path, other]

    for epoch in range(epochs):
        def deal(batches, epoch=epoch):
            """An item block's rows, to the blocks of this epoch."""
            for b in batches:
                for r in b.to_pylist():
                    own = np.frombuffer(r["numbers"], dtype="<i8")
                    mat, to = np.frombuffer(r["mat"], dtype="<f8").reshape(len(own), -1), item_block(own, epoch, blocks, seed)
                    yield from _table([_state(1, x, own[to == x], mat[to == x]) for x in range(blocks)]).to_batches()

        def gathered(group: pa.Table) -> pa.Table:
            own = np.concatenate([np.frombuffer(x, dtype="<i8") for x in group.column("numbers").to_pylist()])
            mat = np.concatenate([np.frombuffer(x, dtype="<f8").reshape(-1, dim + 1) for x in group.column("mat").to_pylist()])
            order = np.argsort(own)
            return _table([_state(1, group.column("block")[0].as_py(), own[order], mat[order])])

        def tiled(batches, epoch=epoch):
            for b in batches:
                i = b.column(1).to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(b.column(0).to_numpy() % blocks), pa.array(item_block(i, epoch, blocks, seed)), b.column(0), b.column(1)], names=["ub", "ib", "u", "i"])

        def packed(group: pa.Table) -> pa.Table:
            u, i = (group.column(c).to_numpy() for c in ("u", "i"))
            order = np.lexsort((i, u))
            return pa.table({"ub": group.column("ub")[:1], "ib": group.column("ib")[:1], "u": pa.array([u[order].astype("<i8").tobytes()]), "i": pa.array([i[order].astype("<i8").tobytes()])})

        def step(batches, epoch=epoch):
            for b in batches:
                for r in b.to_pylist():
                    un, inn = np.frombuffer(r["un"], dtype="<i8"), np.frombuffer(r["inn"], dtype="<i8")
                    um, im = np.frombuffer(r["um"], dtype="<f8").reshape(len(un), -1), np.frombuffer(r["im"], dtype="<f8").reshape(len(inn), -1)
                    if r["u"]:
                        u, i = (np.searchsorted(own, np.frombuffer(x, dtype="<i8")) for own, x in ((un, r["u"]), (inn, r["i"])))
                        um, im = descend(um, im, u, i, (seed, epoch, r["ub"], r["ib"]), rate, reg)
                    yield from _table([_state(0, r["ub"], un, um), _state(1, r["ib"], inn, im)]).to_batches()

        items, path = tables.write(items.mapInArrow(deal, STATE).groupBy("block").applyInArrow(gathered, STATE))
        state.append(path)
        tiles = cut_lineage(placed.mapInArrow(tiled, "ub long, ib long, u long, i long").groupBy("ub", "ib").applyInArrow(packed, "ub long, ib long, u binary, i binary"))
        for turn in range(blocks):
            left = users.select(F.col("block").alias("ub"), F.col("numbers").alias("un"), F.col("mat").alias("um"), ((F.col("block") + turn) % blocks).alias("ib"))
            right = items.select(F.col("block").alias("ib"), F.col("numbers").alias("inn"), F.col("mat").alias("im"))
            out, path = tables.write(left.join(right, "ib").join(tiles, ["ub", "ib"], "left").repartition(blocks, "ub").mapInArrow(step, STATE))
            for old in state:
                tables.drop(old)
            users, items, state = out.where("kind = 0"), out.where("kind = 1"), [path]
        drop_checkpoint(tiles)
    drop_checkpoint(placed)

    def rows(kind: int):
        def run(batches):
            for b in batches:
                for r in b.to_pylist():
                    own = np.frombuffer(r["numbers"], dtype="<i8")
                    mat = np.frombuffer(r["mat"], dtype="<f8").reshape(len(own), -1)
                    if not kind:
                        mat = np.concatenate([mat, np.ones((len(own), 1))], axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(own), pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1, dtype=np.int32) * (dim + 1)), pa.array(mat.reshape(-1)))], names=["number", "factors"])

        return run

    named = lambda state, kind, side: state.mapInArrow(rows(kind), "number long, factors array<double>").join(number[side], "number").select(side, "factors")
    return FactorModel(named(items, 1, item), named(users, 0, user), dim + 1)


def pair_scores(triples: DataFrame, model: FactorModel, user: str = USER, item: str = ITEM) -> DataFrame:
    """``user, item, neg_item, pos_score, neg_score`` of triples; users and items without factors score 0."""
    dot = lambda c: F.coalesce(F.aggregate(F.zip_with("_u", c, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x), F.lit(0.0))
    uf, it = model.user_factors.select(user, F.col("factors").alias("_u")), model.item_factors
    # a positive's score is taken once a pair, so that no triple carries more than its user's factors
    pairs = triples.select(user, item).distinct().join(uf, user, "left").join(it.select(item, F.col("factors").alias("_p")), item, "left")
    met = triples.select(user, item, "neg_item").join(uf, user, "left").join(it.select(F.col(item).alias("neg_item"), F.col("factors").alias("_n")), "neg_item", "left")
    met = met.select(user, item, "neg_item", dot("_n").alias("neg_score")).join(pairs.select(user, item, dot("_p").alias("pos_score")), [user, item], "left")
    return met.select(user, item, "neg_item", F.coalesce("pos_score", F.lit(0.0)).alias("pos_score"), "neg_score")
