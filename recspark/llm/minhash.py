"""Near-duplicate groups: circulant MinHash, banding and exact Jaccard verification."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.llm import rolling as ro
from recspark.llm.arrow import groups, in_arrow, texts
from recspark.llm.components import components
from recspark.llm.stages import cut, let_go, plain, small_side

U = np.uint64
W = np.uint32


def shingle_sets(raws: list[bytes | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle fingerprints of each text, sorted, one after the other, and offsets.

    A-Z are lowered; words are runs outside space and 0x09-0x0D. A text of fewer
    than ``width`` words is one shingle; a text without words, or null, has none.
    """
    joined = b"\n".join(r or b"" for r in raws).lower()
    starts = np.concatenate([[0], np.cumsum([len(r or b"") + 1 for r in raws])])
    h, at = ro.words(joined)
    first = np.searchsorted(at, starts)
    count = np.diff(first)
    n = len(h)
    sums = np.zeros(n, dtype=U)
    short = np.minimum(np.repeat(count, count), width)
    left = np.repeat(first[1:], count) - np.arange(n)  # words from here to the text's end
    for j in range(min(width, n)):
        part = ro.mix(h[j:], j + 1)
        part[short[: n - j] <= j] = 0
        sums[: n - j] += part
    sums = ro.mix(sums + short.astype(U), 99)
    use = left >= short
    who = np.repeat(np.arange(len(raws)), count)[use]
    sums = sums[use]
    sets = []
    for part in np.split(sums, np.flatnonzero(np.diff(who)) + 1):
        if len(part):
            part = np.sort(part)
            sets.append(part[np.concatenate([[True], part[1:] != part[:-1]])])
    size = np.zeros(len(raws), dtype=np.int64)
    size[count > 0] = [len(s) for s in sets]
    return (np.concatenate(sets) if sets else np.zeros(0, dtype=U)), np.concatenate([[0], np.cumsum(size)])


def _pi(x: np.ndarray, tmp: np.ndarray) -> np.ndarray:
    """A permutation of 0 .. 2^32 - 1, applied in place."""
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        np.right_shift(x, W(shift), out=tmp)
        np.bitwise_xor(x, tmp, out=x)
        np.multiply(x, W(factor), out=x)
    np.right_shift(x, W(16), out=tmp)
    np.bitwise_xor(x, tmp, out=x)
    return x


def signatures(elements: np.ndarray, offsets: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash: coordinate k is the least pi(sigma(x) + k mod 2^32) of a set.

    sigma permutes 64-bit fingerprints and places them on a circle of 2^32 positions;
    pi is one permutation of that circle, shifted by one position per coordinate.
    Rows of empty sets hold the largest value.
    """
    sets = len(offsets) - 1
    out = np.full((sets, coordinates), 0xFFFFFFFF, dtype=W)
    full = np.flatnonzero(np.diff(offsets) > 0)
    at = 0
    while at < len(full):  # sets in groups that fit a processor cache
        end = max(at + 1, int(np.searchsorted(offsets[full + 1], offsets[full[at]] + (1 << 15), side="right")))
        lo, hi = offsets[full[at]], offsets[full[end - 1] + 1]
        place = (ro.mix(elements[lo:hi], 7) >> U(32)).astype(W)
        cuts = offsets[full[at:end]] - lo
        x, tmp = np.empty_like(place), np.empty_like(place)
        for k in range(coordinates):
            np.add(place, W(k), out=x)
            out[full[at:end], k] = np.minimum.reduceat(_pi(x, tmp), cuts)
        at = end
    return out


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` coordinates."""
    sets, coordinates = signature.shape
    out = np.empty((sets, coordinates // rows), dtype=U)
    for b in range(coordinates // rows):
        key = np.full(sets, b + 1, dtype=U)
        for j in range(rows):
            key = ro.mix(key ^ (signature[:, b * rows + j].astype(U) + U(0x9E3779B97F4A7C15)), j)
        out[:, b] = key
    return out


def _signed(batches: Iterable[pa.RecordBatch], width: int, bands: int, rows: int, chunk: int) -> Iterator[pa.RecordBatch]:
    for batch in groups(batches, "text", chunk):
        elements, off = shingle_sets(texts(batch, "text"), width)
        size = np.diff(off)
        sums = [np.concatenate([[U(0)], np.cumsum(ro.mix(elements, s))]) for s in (11, 12)]
        keys = band_keys(signatures(elements, off, bands * rows), rows)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(size), *(pa.array((s[off[1:]] - s[off[:-1]]).view(np.int64)) for s in sums),
                pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1, dtype=np.int32) * bands), pa.array(keys.reshape(-1).view(np.int64))),
            ],
            names=["id", "n", "s1", "s2", "bands"],
        )


def _sets(batches: Iterable[pa.RecordBatch], width: int, chunk: int) -> Iterator[pa.RecordBatch]:
    for batch in groups(batches, "text", chunk):
        elements, off = shingle_sets(texts(batch, "text"), width)
        sums = np.concatenate([[U(0)], np.cumsum(ro.mix(elements, 11))])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array((sums[off[1:]] - sums[off[:-1]]).view(np.int64)), pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(elements.view(np.int64)))],
            names=["id", "s1", "elements"],
        )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, width: int = 5,
                    bands: int = 32, rows: int = 4, chunk: int = 2 << 20, block: int = 512) -> DataFrame:
    """One row per input row: ``id_col, n_shingles, component_id, kept``.

    Texts are linked when 100 * |A & B| >= percent * |A | B| over their distinct word
    shingles; component_id is the smallest id reachable over links (its own included),
    kept says that a row's id is its component's. Plan:

    * rows of equal sets (size and two 64-bit sums over the set) become one class,
      named by its smallest id; all further work is on classes;
    * each class is first linked with the class of its buckets that meets most others, and
      the link is verified on full sets; that settles most groups of copies without
      enumerating pairs;
    * buckets that still hold different components are compared in cells, pairs of blocks of
      about ``block`` members (see ``crossing``), so that a large bucket spreads over tasks and a
      set is sent once for each block that its own one meets: pairs of different components and
      fitting sizes are verified there, on full sets, and a spanning forest of the links found
      is returned rather than all pairs. Nothing is capped. One shared bucket is enough: of
      32 bands of 4 rows, a pair at a similarity of 0.85 shares none with probability 6e-11, at
      0.8 with 5e-8.

    Null or blank texts have no shingles and link with nothing. Rows that share an id
    are one node: each of its texts' links are the node's, and each row is returned.
    A null id never links; its component_id is null and it is kept. An empty table
    gives no rows; other columns are ignored.
    """
    source = docs.select(plain(id_col).cast("long").alias("id"), plain(text_col).alias("text"))
    signed = cut(in_arrow(source, lambda it: _signed(it, width, bands, rows, chunk), "id long, n long, s1 long, s2 long, bands array<long>"))
    usable = signed.where("n > 0 and id is not null")
    same = ["n", "s1", "s2"]
    first = cut(usable.groupBy(same).agg(F.min("id").alias("rep")))  # as a table, so that a join may split a hot class
    classes = cut(usable.join(first, same).where("id = rep").select("rep", "n", "s1", "bands").dropDuplicates(["rep", "n", "s1"]))
    buckets = classes.select("rep", "n", "s1", F.explode("bands").alias("key"))
    met = buckets.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    shared = cut(buckets.join(met, "key"))

    # one link a class: with the member of its buckets that meets most others, as an original meets its copies
    weight = shared.groupBy("rep").agg(F.sum("members").alias("weight"))
    hubs = cut(shared.join(weight, "rep").groupBy("key").agg(F.max_by("rep", "weight").alias("hub"), F.max("weight").alias("weight")))
    star = shared.join(hubs, "key").where("rep <> hub").groupBy("rep", "n", "s1").agg(F.max_by("hub", "weight").alias("hub"))
    other = classes.select(F.col("rep").alias("hub"), F.col("n").alias("hub_n"), F.col("s1").alias("b1"))
    star = star.join(other, "hub").where(f"100 * least(n, hub_n) >= {percent} * greatest(n, hub_n)")
    linked = cut(_verified(source, star.select(F.col("rep").alias("a"), F.col("s1").alias("a1"), F.col("hub").alias("b"), "b1"), percent, width, chunk))
    let_go(docs.sparkSession)  # the sets
    label = components(linked).withColumnRenamed("node", "rep")

    # what is left: buckets of several components, whose members meet block by block
    named = shared.join(label, "rep", "left").select("key", "rep", "n", "s1", F.coalesce("component", "rep").alias("component"))
    cell = ["a", "b"]
    near = cut(crossing(named, block).groupBy(cell).applyInArrow(lambda t: _candidates(t, percent), CELL))
    let_go(docs.sparkSession)
    sets = _full_sets(source, near.select("rep").distinct(), near.count(), width, chunk).withColumnRenamed("id", "rep")
    more = near.join(sets, ["rep", "s1"]).select(*near.columns, "elements").groupBy(cell).applyInArrow(lambda t: _links(t, percent), "a long, b long")
    more = cut(more)
    let_go(docs.sparkSession)  # the sets

    equal = usable.join(first, same).where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    node = components(linked.union(more).union(equal)).withColumnRenamed("node", "id")
    component = F.coalesce("component", "id")
    return signed.select("id", "n").join(node, "id", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def _verified(source: DataFrame, pairs: DataFrame, percent: int, width: int, chunk: int) -> DataFrame:
    """Of pairs ``a, a1, b, b1`` (id and set sum of either side), those linked on full sets: ``a, b``."""
    pairs = cut(pairs)
    ends = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sets = cut(_full_sets(source, ends, 2 * pairs.count(), width, chunk))
    one = sets.select(F.col("id").alias("a"), F.col("s1").alias("a1"), F.col("elements").alias("x"))
    two = sets.select(F.col("id").alias("b"), F.col("s1").alias("b1"), F.col("elements").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    held = pairs.join(one, ["a", "a1"]).join(two, ["b", "b1"])
    return held.where(100 * both >= percent * (F.size("x") + F.size("y") - both)).select("a", "b")


def _full_sets(source: DataFrame, ids: DataFrame, rows: int, width: int, chunk: int) -> DataFrame:
    """``id, s1, elements`` of the texts of the given ids, one row per set."""
    ids = small_side(ids.toDF("id"), rows, 16)
    sets = in_arrow(source.join(ids, "id", "left_semi"), lambda it: _sets(it, width, chunk), "id long, s1 long, elements array<long>")
    return sets.dropDuplicates(["id", "s1"])


CELL = "a long, b long, blk long, rep long, n long, s1 long, component long"


def crossing(named: DataFrame, block: int, elements: int = 1 << 19) -> DataFrame:
    """Cells for members ``key, rep, n, s1, component`` of buckets: each pair of blocks that has to meet, with the members that do.

    A member's block is a part of its home, the largest of its buckets that hold several
    components: about ``block`` members, or ``elements`` shingles. So members that share many
    buckets share a home, and whatever number of buckets two of them share, they meet
    in one cell. In a bucket only those outside its commonest component meet all others,
    the members of that component meet just the blocks of such strays.
    """
    inside = named.groupBy("key", "component").agg(F.count("*").alias("m"))
    held = inside.groupBy("key").agg(F.count("*").alias("kinds"), F.max_by("component", "m").alias("main"), F.sum("m").alias("members"))
    mixed = cut(named.join(cut(held.where("kinds > 1").drop("kinds")), "key"))
    home = cut(mixed.groupBy("rep", "n", "s1", "component").agg(F.max(F.struct("members", "key")).alias("home")))
    size = home.groupBy("home").agg(F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("n") / elements)).alias("parts"))
    part = F.pmod(F.xxhash64("rep", "s1"), F.col("parts"))
    who = cut(home.join(cut(size), "home").select(F.xxhash64("home.key", part).alias("blk"), "rep", "n", "s1", "component"))
    placed = cut(mixed.join(who.select("rep", "s1", "blk"), ["rep", "s1"]).select("key", "rep", "s1", "blk", (F.col("component") != F.col("main")).alias("stray")))
    there = cut(placed.groupBy("key").agg(F.collect_set("blk").alias("blocks"), F.collect_set(F.when(F.col("stray"), F.col("blk"))).alias("strays")))
    others = placed.join(there, "key").select("rep", "s1", F.when(F.col("stray"), F.col("blocks")).otherwise(F.col("strays")).alias("others"))
    # a member's buckets are united before it is sent anywhere
    met = others.groupBy("rep", "s1").agg(F.array_distinct(F.flatten(F.collect_set("others"))).alias("others"))
    met = met.join(who, ["rep", "s1"]).withColumn("other", F.explode("others"))
    return met.select(F.least("blk", "other").alias("a"), F.greatest("blk", "other").alias("b"), "blk", "rep", "n", "s1", "component")


def _pairs(cell: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the two blocks of a cell (the same rows on its diagonal), and which pairs to verify here."""
    a, b, blk, rep, n, component = (cell.column(c).to_numpy() for c in ("a", "b", "blk", "rep", "n", "component"))
    left, right = np.flatnonzero(blk == a), np.flatnonzero(blk == b)
    size = n.astype(np.int64)
    ok = component[left, None] != component[None, right]
    ok &= 100 * np.minimum(size[left, None], size[None, right]) >= percent * np.maximum(size[left, None], size[None, right])
    if a[0] == b[0]:
        ok &= np.arange(len(left))[:, None] < np.arange(len(right))
    return left, right, ok


def _candidates(cell: pa.Table, percent: int) -> pa.Table:
    left, right, ok = _pairs(cell, percent)
    keep = np.zeros(cell.num_rows, dtype=bool)
    keep[left[ok.any(axis=1)]] = True
    keep[right[ok.any(axis=0)]] = True
    return cell.filter(pa.array(keep))


def _links(cell: pa.Table, percent: int) -> pa.Table:
    """A spanning forest, over components, of the pairs whose full sets are linked."""
    left, right, ok = _pairs(cell, percent)
    elements = cell.column("elements").combine_chunks()
    rep, n, component = (cell.column(c).to_numpy() for c in ("rep", "n", "component"))
    off = elements.offsets.to_numpy()
    flat = elements.values.to_numpy()
    who = np.repeat(np.arange(len(n)), np.diff(off))
    order = np.argsort(flat[off[0]:off[-1]], kind="stable")
    value, who = flat[off[0]:off[-1]][order], who[order]
    number = np.cumsum(np.concatenate([[0], value[1:] != value[:-1]]))
    often = np.bincount(number)[number] > 1  # elements of one set add to no intersection
    number, who = np.unique(number[often], return_inverse=True)[1], who[often]
    inter = np.zeros((len(left), len(right)), dtype=np.float64)
    total = int(number[-1]) + 1 if len(number) else 0
    for at in range(0, total, 4096):  # 0/1 matrices of bounded width
        lo, hi = np.searchsorted(number, [at, at + 4096])
        part = np.zeros((len(n), 4096), dtype=np.float32)
        part[who[lo:hi], number[lo:hi] - at] = 1
        inter += part[left] @ part[right].T
    union = n[left][:, None] + n[right][None, :] - inter
    found = np.argwhere(ok & (100 * inter >= percent * union))
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    out = []
    for x, y in found.tolist():
        x, y = int(left[x]), int(right[y])
        a, b = root(int(component[x])), root(int(component[y]))
        if a != b:
            parent[a] = b
            out.append((int(rep[x]), int(rep[y])))
    return pa.table({"a": pa.array([a for a, _ in out], type=pa.int64()), "b": pa.array([b for _, b in out], type=pa.int64())})
