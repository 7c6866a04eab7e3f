"""Alignment of two tokenizers' tokens of a text: divide and conquer at ends that both share."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from json import loads

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.llm.arrow import groups, in_arrow, texts
from recspark.llm.stages import cut, plain

#: An id pair is one number, the A id above these bits.
B_BITS = 21
#: A single space between other characters than white space: no token of either tokenizer holds one after such a character.
SEAM = re.compile(r"(?<=\S) (?=\S)")
LATIN = re.compile("[\x00-\u024f]*")
# fixed value: the split of byte-level BPE vocabularies
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def cuts(a: np.ndarray, b: np.ndarray, docs_a: np.ndarray, docs_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the increasing token ends ``a`` and ``b`` of all ends that both hold.

    ``docs_a`` and ``docs_b`` bound each document's tokens (first token, and one past the
    last of all); its last ends are equal. All intervals of a depth are worked on at
    once: each looks its middle end up in the other list by bisection, then the ends one
    step further to either side, until one is shared; there it is cut in two. An interval
    without a shared end inside, or of a single token, is a leaf.
    """
    shared = np.zeros(len(a), dtype=bool)
    filled = np.flatnonzero(np.diff(docs_a) > 0)
    al, ah, bl, bh = docs_a[filled], docs_a[filled + 1], docs_b[filled], docs_b[filled + 1]
    shared[ah - 1] = True
    while len(al):
        inner = (ah - al > 1) & (bh - bl > 1)
        al, ah, bl, bh = al[inner], ah[inner], bl[inner], bh[inner]
        middle = (al + ah - 2) // 2
        at, other = np.full(len(al), -1), np.zeros(len(al), dtype=np.int64)
        open_, step = np.arange(len(al)), 0
        while len(open_):
            for side in ((0,) if step == 0 else (step, -step)):
                probe = middle[open_] + side
                inside = (probe >= al[open_]) & (probe < ah[open_] - 1)
                probe = np.where(inside, probe, al[open_])
                place = np.searchsorted(b, a[probe])
                hit = inside & (b[place] == a[probe])
                at[open_[hit]], other[open_[hit]] = probe[hit], place[hit]
                open_ = open_[~hit]
            step += 1
            open_ = open_[(middle[open_] + step < ah[open_] - 1) | (middle[open_] - step >= al[open_])]
        found = at >= 0
        at, other = at[found], other[found]
        shared[at] = True
        halves = ((al[found], at + 1), (at + 1, ah[found]), (bl[found], other + 1), (other + 1, bh[found]))
        al, ah, bl, bh = (np.stack(x, axis=1).reshape(-1) for x in halves)  # still in the order of the text
    in_a = np.flatnonzero(shared)
    return in_a, np.searchsorted(b, a[in_a])


def _byte_of() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: printable ones stand for themselves, the others follow from 256."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [x for x in range(256) if x not in set(own)]
    return {chr(x): x for x in own} | {chr(256 + k): x for k, x in enumerate(rest)}


class Pair:
    """Both tokenizers and the bytes of every token. Files come as their contents, so tasks open none."""

    def __init__(self, json: str, proto: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task a core
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(json)
        self.a.no_padding()
        self.a.no_truncation()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=proto)
        byte_of = _byte_of()
        self.bytes_a = [bytes(byte_of.get(c, 0x3F) for c in self.a.id_to_token(i) or "") for i in range(self.a.get_vocab_size())]
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.ranked = None
        spec = loads(json)
        made = [spec["model"]["vocab"].get("".join(m if isinstance(m, list) else m.split(" "))) for m in spec["model"]["merges"]]
        added = {t["id"] for t in spec.get("added_tokens", [])}
        if made == sorted(set(made) - {None}) and spec["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
            ranks = {self.bytes_a[i]: i for i in spec["model"]["vocab"].values() if i not in added}
            self.ranked = tiktoken.Encoding("ranked", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.length_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        digits = lambda n, ends: [str(i).encode() + e for e in ends for i in range(n)]
        # each id in decimal and what may follow it: another of its side, or the end of its side's part of the group
        self.written = digits(len(self.bytes_a), (b",", b"|")) + digits(len(self.bytes_b), (b",", b";"))

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of space + text under both.

        Where A's ids rise with its merges, merging by id is merging by rank; the faster library that does so
        encodes Latin text, for which both libraries' character classes are the same.
        """
        if self.ranked and LATIN.fullmatch(text):
            a = self.ranked.encode_ordinary(" " + text)
        else:
            a = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
        return np.array(a, dtype=np.int32), np.array(self.b.encode(text, num_threads=1), dtype=np.int32)

    def gives_back(self, a: np.ndarray, b: np.ndarray, text: str) -> bool:
        whole = b" " + text.encode()
        return b"".join(map(self.bytes_a.__getitem__, a.tolist())) == whole == b"".join(map(self.bytes_b.__getitem__, b.tolist()))


class Chunks:
    """Ids of each distinct stretch between seams, encoded once until more than ``most_tokens`` are held."""

    def __init__(self, pair: Pair, most_tokens: int, piece_chars: int):
        self.pair, self.most, self.piece = pair, most_tokens, piece_chars
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.whole = np.zeros(0, dtype=bool)
        self.off = [np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)]
        self.ids = [np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32)]

    def _pieces(self, new: list[str]) -> Iterator[list[str]]:
        """Stretches that may be encoded as one text: joined by single spaces, they are separated by seams again."""
        pieces, chars = ([], []), [0, 0]
        for c in new:
            if not c or c[0].isspace() or c[-1].isspace():
                yield [c]
                continue
            kind = LATIN.fullmatch(c) is None
            pieces[kind].append(c)
            chars[kind] += len(c) + 1
            if chars[kind] > self.piece:
                yield pieces[kind][:]
                pieces[kind].clear()
                chars[kind] = 0
        yield from (p for p in pieces if p)

    def _learn(self, new: list[str]) -> None:
        whole, ids, sizes = [self.whole], [[self.ids[0]], [self.ids[1]]], [[], []]
        todo = list(self._pieces(new))[::-1]
        while todo:
            piece = todo.pop()
            text = " ".join(piece)
            found = self.pair.encode(text)
            good = self.pair.gives_back(*found, text)
            if not good and len(piece) > 1:
                todo += [[c] for c in piece[::-1]]
                continue
            ends = np.cumsum([len(c.encode()) + 1 for c in piece])
            for side, length in enumerate((self.pair.length_a, self.pair.length_b)):
                upto = np.searchsorted(np.cumsum(length[found[side]]), ends) + 1 if good else np.array([len(found[side])])
                sizes[side].append(np.diff(upto, prepend=0))
                ids[side].append(found[side])
            whole.append(np.full(len(piece), good))
            for c in piece:
                self.place[c] = len(self.place)
        self.whole = np.concatenate(whole)
        for side in (0, 1):
            self.ids[side] = np.concatenate(ids[side])
            self.off[side] = np.concatenate([self.off[side], self.off[side][-1] + np.cumsum(np.concatenate(sizes[side]))])

    def encode(self, raws: list[bytes | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of either side all ids, and the bounds of each text's; texts that are not given back have none."""
        if len(self.ids[0]) + len(self.ids[1]) > self.most:
            self.forget()
        parts = [SEAM.split(raw.decode()) if raw else [] for raw in raws]
        new = [c for c in dict.fromkeys(c for part in parts for c in part) if c not in self.place]
        if new:
            self._learn(new)
        size = np.array([len(part) for part in parts], dtype=np.int64)
        code = np.array([self.place[c] for part in parts for c in part], dtype=np.int64)
        text = np.repeat(np.arange(len(raws)), size)
        bad = np.bincount(text, weights=~self.whole[code], minlength=len(raws)) > 0
        code, text = code[~bad[text]], text[~bad[text]]
        out = []
        for side in (0, 1):
            start = self.off[side][code]
            n = self.off[side][code + 1] - start
            at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
            each = np.bincount(text, weights=n, minlength=len(raws)).astype(np.int64)
            out.append((self.ids[side][at].astype(np.int64), np.concatenate([[0], np.cumsum(each)])))
        return out


@lru_cache(maxsize=2)
def _pair(json: str, proto: bytes) -> Pair:
    return Pair(json, proto)


def align(chunks: Chunks, raws: list[bytes | None]) -> dict:
    """Per text ``n_a, n_b, n_groups`` and ``groups`` (the written groups), and per link its text and id pair.

    Texts that are null, empty, or not given back by either tokenizer's tokens have none.
    """
    pair = chunks.pair
    (a, docs_a), (b, docs_b) = chunks.encode(raws)
    n_a, n_b = np.diff(docs_a), np.diff(docs_b)
    at_a, at_b = cuts(np.cumsum(pair.length_a[a]), np.cumsum(pair.length_b[b]), docs_a, docs_b)
    # a group ends with one token of each side, which are its only pair of equal ends
    first = np.searchsorted(at_a, docs_a)  # of each text's groups
    last_a, last_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
    last_a[at_a], last_b[at_b] = 1, 1
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    before_b = np.concatenate([[0], at_b + 1])  # B tokens before each group
    written = np.zeros(len(a) + len(b), dtype=np.int64)
    written[np.arange(len(a)) + before_b[group_a]] = a + last_a * len(pair.bytes_a)
    written[np.arange(len(b)) + (at_a + 1)[group_b] if len(b) else []] = 2 * len(pair.bytes_a) + b + last_b * len(pair.bytes_b)
    parts = list(map(pair.written.__getitem__, written.tolist()))
    off = (docs_a + docs_b).tolist()
    return {
        "n_a": n_a, "n_b": n_b, "n_groups": np.diff(first),
        "groups": [b"".join(parts[i:j])[:-1] for i, j in zip(off, off[1:])],
        "text": np.repeat(np.arange(len(raws)), np.diff(first)), "pair": a[at_a] << B_BITS | b[at_b],
    }


class _Counts:
    """Sums by id pair inside a task, given out whenever they pass a bound."""

    def __init__(self, most: int):
        self.most, self.total, self.parts = most, pd.Series(dtype="int64"), []

    def add(self, key: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        self.parts.append(pd.Series(n, index=key))
        if sum(map(len, self.parts)) > self.most:
            yield from self.out(self.most // 2)

    def out(self, least: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        total = pd.concat([self.total, *self.parts])
        self.total, self.parts = total.groupby(level=0).sum(), []
        if len(self.total) > least:
            yield self.total.index.to_numpy().astype(np.int64), self.total.to_numpy().astype(np.int64)
            self.total = pd.Series(dtype="int64")


BLOCK = "kind int, docs binary, links binary, pair array<long>, n array<long>"


def _blocks(batches: Iterable[pa.RecordBatch], load, most_bytes: int, most_pairs: int, most_tokens: int, piece_chars: int) -> Iterator[pa.RecordBatch]:
    """Rows of kind 0: a block of texts, packed. Rows of kind 1: id pairs and their links in this task."""
    import zstandard

    counts, chunks = _Counts(most_pairs), None
    names = ["kind", "docs", "links", "pair", "n"]
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def row(*values):
        return pa.RecordBatch.from_arrays([pa.array([v], type=t) for v, t in zip(values, kinds)], names=names)

    for batch in groups(batches, "text", most_bytes):
        chunks = chunks or Chunks(load(), most_tokens, piece_chars)
        found = align(chunks, texts(batch, "text"))
        # within a text the links are a multiset: distinct pairs in order, and how often
        both, n = np.unique(found["text"] << 2 * B_BITS | found["pair"], return_counts=True)
        key = both >> 2 * B_BITS, both & ((1 << 2 * B_BITS) - 1)
        sha = [hashlib.sha256(g).hexdigest() if g else "" for g in found["groups"]]
        docs = pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k, c in enumerate(batch.schema.names) if c != "text"), pa.array(found["n_a"]), pa.array(found["n_b"]), pa.array(found["n_groups"]), pa.array(sha),
             pa.array(np.bincount(key[0], minlength=batch.num_rows))],
            names=[*(c for c in batch.schema.names if c != "text"), "n_a", "n_b", "n_groups", "sha", "pairs"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, docs.schema) as to:
            to.write_batch(docs)
        press = zstandard.ZstdCompressor(level=1)
        links = np.concatenate([key[1] >> B_BITS, key[1] & ((1 << B_BITS) - 1), n]).astype(np.int32)
        links = np.ascontiguousarray(links.view(np.uint8).reshape(-1, 4).T)  # equal bytes of all numbers together
        yield row(0, press.compress(sink.getvalue().to_pybytes()), press.compress(links.tobytes()), None, None)
        for k, c in counts.add(key[1], n):
            yield row(1, None, None, k, c)
    for k, c in counts.out():
        yield row(1, None, None, k, c)


def _links(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    a, b, n = np.ascontiguousarray(raw.reshape(4, -1).T).view(np.int32).reshape(3, -1).astype(np.int64)
    return a << B_BITS | b, n


def _looked_up(batches: Iterable[pa.RecordBatch], head: tuple) -> Iterator[pa.RecordBatch]:
    """One row per text, its sums over the links of head pairs, and the pairs that are not in the head."""
    import zstandard

    keys, count, best = head
    for batch in batches:
        for docs, links in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(docs)).read_all().combine_chunks()
            pair, n = _links(links)
            off = np.concatenate([[0], np.cumsum(rows["pairs"].to_numpy())])
            at = np.minimum(np.searchsorted(keys, pair), max(0, len(keys) - 1))
            known = keys[at] == pair if len(keys) else np.zeros(len(pair), dtype=bool)
            sums = []
            for value in (best, count):
                each = np.where(known, value[at], 0) * n if len(keys) else np.zeros(len(pair), dtype=np.int64)
                total = np.concatenate([[0], np.cumsum(each)])
                sums.append(pa.array(total[off[1:]] - total[off[:-1]]))
            rest = np.flatnonzero(~known)
            cut_ = pa.array(np.searchsorted(rest, off).astype(np.int32))
            out = rows.drop_columns(["pairs"]).to_batches()[0] if rows.num_rows else None
            if out is not None:
                yield pa.RecordBatch.from_arrays(
                    [*out.columns, *sums, pa.ListArray.from_arrays(cut_, pa.array(pair[rest])), pa.ListArray.from_arrays(cut_, pa.array(n[rest]))],
                    names=[*out.schema.names, "n_best", "count_sum", "tail", "times"])


def _head(table: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The most counted pairs, ``most`` at most: sorted pairs, their counts, and 1 where a count is its B id's highest."""
    level = F.floor(F.log2("n") * 8).cast("int")
    have, least = 0, None
    for r in sorted(table.groupBy(level.alias("level")).agg(F.count("*").alias("rows")).collect(), reverse=True):
        if have + r["rows"] > most:
            break
        have, least = have + r["rows"], r["level"]
    if least is None:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(3))
    rows = table.where(level >= least).select("pair", "n", F.col("best").cast("long")).toArrow()
    pair = rows.column(0).to_numpy()
    order = np.argsort(pair)
    return tuple(rows.column(k).to_numpy()[order] for k in range(3))


def aligned(docs: DataFrame, path_a: str, path_b: str, keep: list[str] | None = None, text_col: str = "text", most_bytes: int = 2 << 20,
            most_pairs: int = 1 << 21, head_rows: int = 1 << 20, most_tokens: int = 1 << 23, piece_chars: int = 1 << 16) -> DataFrame:
    """Columns ``keep`` and ``n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    A is a byte-level BPE of the tokenizers library (JSON file), B a sentencepiece model;
    both encode a space and the whole text. Ends that tokens of both sides share cut the
    tokens into groups; the two tokens that end a group are linked. A pair of ids counts
    its links in all texts. ``n_best`` are the links whose pair no other pair of the same
    B id exceeds, ``count_sum`` sums the counts over a text's links.

    Null and empty texts, and those that the tokens of a side do not give back byte by
    byte, have zeros and ''. Repeated rows are aligned, counted and returned one by one;
    other columns are ignored; an empty table gives no rows.

    Texts are encoded once: blocks of texts keep their links packed (checkpointed) while
    tasks sum the links by id pair, which a group-by completes. The ``head_rows`` most
    counted pairs are broadcast (a fixed bound of 24 bytes a pair); a text's other pairs
    are joined with the whole table, so results do not depend on the bound. What lies
    between two seams (single spaces between visible characters) is the same tokens
    wherever it stands, as no token crosses a seam: a task encodes each distinct stretch once,
    many joined by seams at a time, and holds ``most_tokens`` ids. A text without seams is
    one stretch.
    """
    spark = docs.sparkSession
    keep = ["doc_id"] if keep is None else keep
    files = spark.sparkContext.broadcast((open(path_a, encoding="utf-8").read(), open(path_b, "rb").read()))
    rows = docs.select(*(plain(c).alias(f"k{i}") for i, c in enumerate(keep)), plain(text_col).alias("text"))
    blocks = cut(in_arrow(rows, lambda it: _blocks(it, lambda: _pair(*files.value), most_bytes, most_pairs, most_tokens, piece_chars), BLOCK))
    each = blocks.where("kind = 1").select(F.explode(F.arrays_zip("pair", "n")).alias("x")).select("x.pair", "x.n")
    counted = cut(each.groupBy("pair").agg(F.sum("n").alias("n")))
    b_id = F.col("pair").bitwiseAND((1 << B_BITS) - 1)
    highest = counted.groupBy(b_id.alias("b")).agg(F.max("n").alias("highest"))
    table = cut(counted.join(highest, b_id == F.col("b")).select("pair", "n", (F.col("n") == F.col("highest")).alias("best")))
    head = spark.sparkContext.broadcast(_head(table, head_rows))
    kinds = ", ".join([*(f"k{i} {rows.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep))),
                       "n_a long, n_b long, n_groups long, sha string, n_best long, count_sum long, tail array<long>, times array<long>"])
    looked = cut(in_arrow(blocks.where("kind = 0").select("docs", "links"), lambda it: _looked_up(it, head.value), kinds)).withColumn("row", F.monotonically_increasing_id())
    tail = looked.select("row", F.explode(F.arrays_zip("tail", "times")).alias("x")).select("row", "x.tail", "x.times")
    more = tail.join(table, F.col("tail") == F.col("pair")).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("times")).alias("more_sum"))
    return looked.join(more, "row", "left").select(
        *(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"), (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), F.col("sha").alias("groups_sha256"))
