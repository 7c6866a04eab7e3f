"""Products of a sparse users × items matrix with narrow dense ones, on a two-dimensional grid.

Users and items are numbered along falling counts and cut into blocks of numbers; a tile holds
the cells of one user block and one item block in compressed rows. A dense side is one
matrix per block. A product sends each block's matrix to the tiles of its row or column and
sums the tiles' parts by block, so what is shuffled grows with (users + items) × width × grid
side, not with the cells. Numbering by count puts most cells into few dense tiles and leaves
many tiles of rare users and items empty; empty tiles don't exist.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.operators.order import global_index
from recspark.session import cut_lineage, freed

BROADCAST_BYTES = 16 << 20  # a measured dense side up to this size is broadcast, a larger one is joined by block
LEAST_BLOCK, MOST_BLOCK = 1 << 11, 1 << 16  # rows of a block: a matrix of 64 columns is 1 to 32 MB


@dataclass
class Tiles:
    """``cells``: u_block, i_block, ptr (rows with cells, and where their cells start), col, val. Numbers: key, number."""

    cells: DataFrame
    numbers: dict[str, DataFrame]
    count: dict[str, int]
    block: int

    def blocks(self, side: str) -> int:
        return -(-self.count[side] // self.block)


def block_rows(users: int, items: int, cells: int) -> int:
    """The smallest power of two with as many cells in an average tile as rows in a block, within bounds."""
    wanted = users * items / max(1, cells)
    return int(min(MOST_BLOCK, max(LEAST_BLOCK, 2 ** np.ceil(np.log2(max(1.0, wanted))))))


def tiled(cells: DataFrame, user: str, item: str, block: int | None = None) -> Tiles:
    """Tiles of the cells ``user, item, v`` (one row per cell)."""
    numbers, count = {}, {}
    for side in (user, item):
        sizes = cells.groupBy(side).agg((-F.count("*")).alias("_less"))
        numbers[side] = cut_lineage(global_index(sizes, ["_less", side], "number").select(side, "number"))
        count[side] = numbers[side].count()
    block = block or block_rows(count[user], count[item], cells.count())

    def pack(group: pa.Table) -> pa.Table:
        row, col, val = (group.column(c).to_numpy() for c in ("row", "col", "v"))
        order = np.lexsort((col, row))
        rows, start = np.unique(row[order], return_index=True)
        return pa.table({"u_block": group.column("u_block")[:1], "i_block": group.column("i_block")[:1], "rows": pa.array([rows.astype("<i4").tobytes()]),
                         "start": pa.array([start.astype("<i8").tobytes()]), "col": pa.array([col[order].astype("<i4").tobytes()]), "val": pa.array([val[order].astype("<f8").tobytes()])})

    known = cells.join(numbers[user].withColumnRenamed("number", "_u"), user).join(numbers[item].withColumnRenamed("number", "_i"), item)
    placed = known.select(*(F.floor(F.col(c) / block).cast("long").alias(f"{n}_block") for n, c in (("u", "_u"), ("i", "_i"))),
                          (F.col("_u") % block).alias("row"), (F.col("_i") % block).alias("col"), F.col("v").cast("double").alias("v"))
    tiles = placed.groupBy("u_block", "i_block").applyInArrow(pack, "u_block long, i_block long, rows binary, start binary, col binary, val binary")
    return Tiles(cut_lineage(tiles), {"u": numbers[user], "i": numbers[item]}, {"u": count[user], "i": count[item]}, block)


def _parts(batches: Iterable[pa.RecordBatch], to_items: bool, width: int, step: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """One row per tile: the rows of its output block that it adds to, and what it adds."""
    for b in batches:
        for tile in b.to_pylist():
            rows, start = np.frombuffer(tile["rows"], dtype="<i4"), np.frombuffer(tile["start"], dtype="<i8")
            col, val = np.frombuffer(tile["col"], dtype="<i4"), np.frombuffer(tile["val"], dtype="<f8")
            row = np.repeat(rows, np.diff(np.append(start, len(col))))
            if to_items:
                order = np.argsort(col, kind="stable")
                row, col, val = col[order], row[order], val[order]
                rows, start = np.unique(row, return_index=True)
            mat = np.frombuffer(tile["mat"], dtype="<f8").reshape(-1, width)
            out, at = np.zeros((len(rows), width)), 0
            place = np.repeat(np.arange(len(rows)), np.diff(np.append(start, len(col))))
            while at < len(col):
                end = min(len(col), at + step)
                own = place[at:end]
                first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                out[own[first]] += np.add.reduceat(mat[col[at:end]] * val[at:end, None], first, axis=0)
                at = end
            yield pa.RecordBatch.from_arrays([pa.array([tile["i_block" if to_items else "u_block"]]), pa.array([rows.astype("<i4").tobytes()]), pa.array([out.tobytes()])], names=["block", "rows", "mat"])


def _summed(batches: Iterable[pa.RecordBatch], size: int, total: int, width: int) -> Iterator[pa.RecordBatch]:
    """Parts in the order of their blocks to one matrix per run of a block."""
    block, acc = None, None

    def out():
        return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([acc.tobytes()])], names=["block", "mat"])

    for b in batches:
        for part in b.to_pylist():
            if part["block"] != block:
                if block is not None:
                    yield out()
                block = part["block"]
                acc = np.zeros((min(size, total - block * size), width))
            mat = np.frombuffer(part["mat"], dtype="<f8").reshape(-1, width)
            if "rows" in part:
                acc[np.frombuffer(part["rows"], dtype="<i4")] += mat
            else:
                acc += mat
    if block is not None:
        yield out()


def product(tiles: Tiles, dense: DataFrame, to: str, width: int) -> DataFrame:
    """X · dense (``to`` "u": dense is by item block) or its transpose's (``to`` "i"): block, mat.

    Parts of one block are summed in the task that made them, then in the one that the block goes to.
    """
    of = "i" if to == "u" else "u"
    side = dense.withColumnRenamed("block", f"{of}_block")
    # Spark takes a block for a short row and would broadcast a side of any size: the driver would hold it
    side = F.broadcast(side) if 8 * tiles.count[of] * width <= BROADCAST_BYTES else side.hint("merge")
    size, total = tiles.block, tiles.count[to]
    met = tiles.cells.join(side, f"{of}_block")
    parts = met.sortWithinPartitions(f"{to}_block").mapInArrow(lambda it: _summed(_parts(it, to == "i", width), size, total, width), "block long, mat binary")
    whole = parts.repartition(F.col("block")).sortWithinPartitions("block").mapInArrow(lambda it: _summed(it, size, total, width), "block long, mat binary")
    return cut_lineage(whole)


def gram(dense: DataFrame, width: int) -> np.ndarray:
    """DᵀD of the blocks' rows, summed from one width × width part per task."""
    def partial(batches):
        acc = np.zeros((width, width))
        for b in batches:
            for mat in b.column(0).to_pylist():
                x = np.frombuffer(mat, dtype="<f8").reshape(-1, width)
                acc += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(acc.ravel())], names=["idx", "g"])

    g = np.zeros(width * width)
    with freed(dense.sparkSession):
        for r in dense.select("mat").mapInArrow(partial, "idx long, g double").groupBy("idx").agg(F.sum("g").alias("g")).collect():
            g[r["idx"]] = r["g"]
    return g.reshape(width, width)


def times(dense: DataFrame, t: np.ndarray) -> DataFrame:
    """Every block times ``t``, which is width × width at most."""
    def run(batches):
        for b in batches:
            mats = [(np.frombuffer(m, dtype="<f8").reshape(-1, len(t)) @ t).tobytes() for m in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(mats, type=pa.binary())], names=["block", "mat"])

    return dense.select("block", "mat").mapInArrow(run, "block long, mat binary")


def gaussian(tiles: Tiles, side: str, width: int, seed: int) -> DataFrame:
    """Standard-normal blocks; a block's numbers depend on the seed and its own number alone."""
    size, total = tiles.block, tiles.count[side]

    def run(batches):
        for b in batches:
            blocks = b.column(0).to_pylist()
            mats = [np.random.Generator(np.random.Philox(key=[seed, k])).standard_normal((min(size, total - k * size), width)).tobytes() for k in blocks]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(mats, type=pa.binary())], names=["block", "mat"])

    return tiles.cells.sparkSession.range(tiles.blocks(side)).toDF("block").mapInArrow(run, "block long, mat binary")


def rows_of(tiles: Tiles, dense: DataFrame, side: str, width: int, name: str) -> DataFrame:
    """The blocks' rows by key: key, ``name`` (array of doubles)."""
    size = tiles.block

    def run(batches):
        for b in batches:
            for block, mat in zip(*(b.column(k).to_pylist() for k in (0, 1))):
                x = np.frombuffer(mat, dtype="<f8")
                n = len(x) // width
                for at in range(0, n, 1 << 12):
                    m = min(n, at + (1 << 12)) - at
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(block * size + np.arange(at, at + m)), pa.ListArray.from_arrays(pa.array(np.arange(m + 1, dtype=np.int32) * width), pa.array(x[at * width:(at + m) * width]))], names=["number", name])

    return dense.select("block", "mat").mapInArrow(run, f"number long, {name} array<double>").join(tiles.numbers[side], "number").drop("number")
