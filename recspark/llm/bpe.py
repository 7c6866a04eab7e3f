"""Byte-pair encoding and decoding with a pair occurrence index over slices of a partition."""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from recspark.llm import rolling as ro
from recspark.llm.arrow import give_back, groups, in_arrow
from recspark.llm.stages import plain

U = np.uint64
SPACE, LETTER, NUMBER, OTHER, SPECIAL, UNKNOWN = range(6)

#: The split rule of the supported vocabulary file.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

#: Beyond these, Python's character tables may lack characters that the library's have.
RARE = re.compile("[^\x00-\u024f]")
_CLASS = np.full(0x110000, UNKNOWN, dtype=np.uint8)
_CLASS[WHITE] = SPACE
_CLASS[0xD800:0xE000] = SPECIAL  # no text holds surrogates; special tokens are written as such


@lru_cache(maxsize=2)
def _library_class(major: str):
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(rf"\p{{{major}}}"), "removed", invert=True)


def classes(codes: np.ndarray) -> np.ndarray:
    """Space, letter, number or other of each code point; looked up once per code point."""
    out = _CLASS[codes]
    if (out == UNKNOWN).any():
        for c in np.unique(codes[out == UNKNOWN]).tolist():
            major = unicodedata.category(chr(c))
            if major == "Cn":  # perhaps assigned in the library's newer character tables
                major = next((k for k in "LN" if _library_class(k).pre_tokenize_str(chr(c))), "C")
            _CLASS[c] = {"L": LETTER, "N": NUMBER}.get(major[0], OTHER)
        out = _CLASS[codes]
    return out


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, the rest from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Merges and tokens of a vocabulary file with word ends, as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if pattern != SPLIT or steps != ["NFC", "Replace", "Lowercase"] or model["end_of_word_suffix"] != "</w>":
            raise ValueError(f"{path}: not a vocabulary of the supported kind")
        vocab = model["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_ids = list(self.special.values())
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.mark = {t: chr(0xD800 + k) for k, t in enumerate(self.special)}
        names = {i: t for t, i in [*vocab.items(), *self.special.items()]}
        self.tokens = [names.get(i, "") for i in range(max(names) + 1)]
        chars = byte_characters()
        self.inner = np.array([vocab[c] for c in chars], dtype=np.int32)
        self.final = np.array([vocab[c + "</w>"] for c in chars], dtype=np.int32)
        self.left = np.array([vocab[a] for a, _ in pairs], dtype=np.int32)
        self.right = np.array([vocab[b] for _, b in pairs], dtype=np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        used = np.zeros(len(self.tokens), dtype=np.int64) + len(pairs)
        np.minimum.at(used, self.left, np.arange(len(pairs)))
        np.minimum.at(used, self.right, np.arange(len(pairs)))
        if len(set(self.made.tolist())) < len(pairs) or (used[self.made] <= np.arange(len(pairs))).any():
            raise ValueError(f"{path}: a token is made by two merges, or used before it is made")
        key = (self.left.astype(U) << U(32)) | self.right.astype(U)
        order = np.argsort(key)
        self.keys, self.key_rank = key[order], order.astype(np.int32)
        self.slot = np.full(1 << 20, -1, dtype=np.int32)  # first guess of a pair's place in keys
        self.slot[self._hash(self.keys)] = np.arange(len(pairs))
        lost = self.slot[self._hash(self.keys)] != np.arange(len(pairs))
        self.crowded = np.zeros(1 << 20, dtype=bool)
        self.crowded[self._hash(self.keys[lost])] = True

    @staticmethod
    def _hash(key: np.ndarray) -> np.ndarray:
        return ((key * U(0x9E3779B97F4A7C15)) >> U(44)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, -1 where there is none."""
        key = (left.astype(U) << U(32)) | right.astype(U)
        at = self._hash(key)
        place = self.slot[at]
        out = np.where((place >= 0) & (self.keys[place] == key), self.key_rank[place], np.int32(-1))
        again = np.flatnonzero((out < 0) & self.crowded[at])
        if len(again):
            p = np.minimum(np.searchsorted(self.keys, key[again]), len(self.keys) - 1)
            out[again] = np.where(self.keys[p] == key[again], self.key_rank[p], np.int32(-1))
        return out

    def normalise(self, text: str) -> str:
        """NFC, then each character's lower case; special tokens become marks, not normalised."""
        if self.special_split and "<" in text:
            parts = self.special_split.split(text)
            if len(parts) > 1:
                return "".join(self.mark[p] if k % 2 else self._lower(p) for k, p in enumerate(parts))
        return self._lower(text)

    @staticmethod
    def _lower(text: str) -> str:
        if text.isascii():
            return text.lower()
        if RARE.search(text) and any(unicodedata.category(c) == "Cn" for c in set(text)):
            from tokenizers import normalizers

            return normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]).normalize_str(text)
        text = unicodedata.normalize("NFC", text)
        return (text.replace("Σ", "σ") if "Σ" in text else text).lower()

    def merge(self, raw: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words given as joined bytes and their ends; second, the word of each id.

        The index maps each pair that has a merge to the positions where it stands. The
        lowest active rank is applied to all its positions at once, the neighbours' pairs
        enter the lists of their ranks. A merge's rank is above those that made its parts
        (checked when the file is read), so no rank becomes active again.
        """
        b = np.frombuffer(raw, dtype=np.uint8)
        n = len(b)
        sym = self.inner[b]
        sym[ends - 1] = self.final[b[ends - 1]]
        nxt = np.arange(1, n + 1, dtype=np.int32)
        prv = np.arange(-1, n - 1, dtype=np.int32)
        nxt[ends - 1] = -1
        prv[np.concatenate([[0], ends[:-1]])] = -1
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(rank: np.ndarray, at: np.ndarray) -> None:
            order = np.argsort(rank, kind="stable")
            rank, at = rank[order], at[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            starts = [0, *cuts.tolist(), len(rank)]
            for r, i, j in zip(rank[starts[:-1]].tolist(), starts, starts[1:]):
                have = index.get(r)
                if have is None:
                    index[r] = [at[i:j]]
                    heapq.heappush(active, r)
                else:
                    have.append(at[i:j])

        for lo in range(0, n, 1 << 18):  # blocks bound the work arrays
            at = np.flatnonzero(nxt[lo:lo + (1 << 18)] >= 0).astype(np.int32) + np.int32(lo)
            rank = self.ranks(sym[at], sym[nxt[at]])
            if (rank >= 0).any():
                enter(rank[rank >= 0], at[rank >= 0])
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            at = lists[0] if len(lists) == 1 else np.concatenate(lists)
            left, right, new = int(self.left[r]), int(self.right[r]), int(self.made[r])
            nx = nxt[at]
            ok = (sym[at] == left) & (nx >= 0)
            ok &= sym[nx] == right
            if not ok.all():
                at, nx = at[ok], nx[ok]
            if not len(at):
                continue
            if left == right:  # of a run of the same symbol, every second position from its left end
                at = np.sort(at)
                new_run = np.concatenate([[True], nxt[at[:-1]] != at[1:]])
                first = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - first) % 2 == 0]
                nx = nxt[at]
            after = nxt[nx]
            sym[at] = new
            sym[nx] = -1
            nxt[at] = after
            some = after >= 0
            prv[after[some]] = at[some]
            before = prv[at]
            lead = before[(before >= 0)]
            lead = lead[sym[lead] != new]  # a neighbour made just now has the pair as its own right one
            own = at[some]
            first = np.concatenate([lead, own])
            rank = self.ranks(sym[first], sym[nxt[first]])
            ok = rank >= 0
            if ok.any():
                enter(rank[ok], first[ok])
        alive = np.flatnonzero(sym >= 0)
        return sym[alive], np.searchsorted(ends, alive, side="right")


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Slice:
    """Texts as sequences of word numbers; each distinct word is kept once."""

    BLOCK = 1 << 17

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.number, self.words, self.docs = vocab, {}, [], []

    def add(self, texts: list[str | None]) -> None:
        group, size = [], 0
        for t in texts:
            group.append(self.vocab.normalise(t or ""))
            size += len(group[-1])
            if size >= self.BLOCK:
                self._split(group)
                group, size = [], 0
        if group:
            self._split(group)

    def _split(self, texts: list[str]) -> None:
        joined = " ".join(texts) + " "
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kind = classes(codes)
        start = np.empty(len(kind), dtype=bool)
        start[0] = kind[0] != SPACE
        np.not_equal(kind[1:], kind[:-1], out=start[1:])
        start |= (kind == NUMBER) | (kind == SPECIAL)
        start &= kind != SPACE
        quotes = np.flatnonzero((codes == 0x27) & start)
        for q in quotes[kind[np.minimum(quotes + 1, len(kind) - 1)] == LETTER].tolist():
            tail = next((c for c in CONTRACTIONS if joined.startswith(c, q + 1)), None)
            if tail:  # the apostrophe and the ending are one word, what follows begins another
                start[q + 1] = False
                if kind[q + 1 + len(tail)] == LETTER:
                    start[q + 1 + len(tail)] = True
        s = np.flatnonzero(start)
        gap = np.flatnonzero(kind == SPACE)
        e = np.minimum(np.append(s[1:], len(kind)), gap[np.minimum(np.searchsorted(gap, s), len(gap) - 1)]) if len(s) else s
        h = ro.fingerprints(codes, s, e)
        local, distinct = pd.factorize(h)
        seen = np.full(len(distinct), -1, dtype=np.int64)
        seen[local[::-1]] = np.arange(len(s))[::-1]
        number, words = self.number, self.words
        to = np.empty(len(distinct), dtype=np.int32)
        for k, (x, i, j) in enumerate(zip(distinct.tolist(), s[seen].tolist(), e[seen].tolist())):
            at = number.get(x)
            if at is None:
                at = number[x] = len(words)
                words.append(joined[i:j])
            to[k] = at
        ids = to[local] if len(s) else np.zeros(0, dtype=np.int32)
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.docs.extend(np.split(ids, np.searchsorted(s, ends[:-1])))

    def encoded(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, offsets) of successive groups of the added texts."""
        marked = np.array([w[0] >= "\ud800" and w[0] < "" for w in self.words], dtype=bool)
        plain_words = ["!" if m else w for w, m in zip(self.words, marked.tolist())]
        ends = np.cumsum([len(w) if w.isascii() else len(w.encode()) for w in plain_words])
        if plain_words:
            ids, word = self.vocab.merge("".join(plain_words).encode(), ends)
            count = np.bincount(word, minlength=len(plain_words))
            del word
        else:
            ids, count = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        off = np.concatenate([[0], np.cumsum(count)])
        for k in np.flatnonzero(marked).tolist():
            ids[off[k]] = self.vocab.special_ids[ord(self.words[k]) - 0xD800]
        at = 0
        size = np.cumsum([len(d) for d in self.docs])
        while at < len(self.docs):
            end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + (1 << 19), side="right")))
            w = np.concatenate(self.docs[at:end])
            n = count[w]
            stop = np.cumsum(n)
            flat = ids[np.repeat(off[w] - (stop - n), n) + np.arange(stop[-1] if len(stop) else 0)]
            total = np.concatenate([[0], stop])
            yield flat, total[np.concatenate([[0], np.cumsum([len(d) for d in self.docs[at:end]])])]
            at = end


def encode_batches(batches: Iterable[pa.RecordBatch], path: str, most_bytes: int, most_words: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows without ``text``, the ids of their texts one after the other, and offsets."""
    vocab = vocabulary(path)

    def flush():
        rows = pa.Table.from_batches(kept).combine_chunks()
        at = 0
        for ids, off in now.encoded():
            n = len(off) - 1
            yield rows.slice(at, n).combine_chunks().to_batches()[0], ids, off
            at += n

    now, kept, size = Slice(vocab), [], 0
    for batch in groups(batches, "text", 2 << 20):
        text = batch.column(batch.schema.names.index("text"))
        now.add(text.to_pylist())
        kept.append(batch.select([c for c in batch.schema.names if c != "text"]))
        size += text.nbytes
        if size >= most_bytes or len(now.words) >= most_words:
            yield from flush()
            now, kept, size = Slice(vocab), [], 0
            give_back()
    if kept:
        yield from flush()


def _encode(batches, path, most_bytes, most_words):
    for rows, ids, off in encode_batches(batches, path, most_bytes, most_words):
        arrays = [*rows.columns, pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids))]
        yield pa.RecordBatch.from_arrays(arrays, names=[*rows.schema.names, "ids"])


def _decode(batches, path):
    token = vocabulary(path).tokens
    for batch in batches:
        for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
            col = part.column(part.schema.names.index("ids"))
            text = [None if x is None else " ".join([token[i] for i in x.tolist()]) for x in (None if not v.is_valid else v.values.to_numpy(zero_copy_only=False) for v in col)]
            names = [c for c in part.schema.names if c != "ids"]
            yield pa.RecordBatch.from_arrays([*(part.column(part.schema.names.index(c)) for c in names), pa.array(text, type=pa.string())], names=[*names, "text"])


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", most_bytes: int = 16 << 20, most_words: int = 1_000_000) -> DataFrame:
    """``id_col`` and ``ids array<int>`` of every whole text (null: as empty), without special tokens added.

    Equal to the tokenizers library on the same file. A partition is encoded in slices:
    a slice ends once it holds ``most_bytes`` of text or ``most_words`` distinct words
    (memory bounds; the result does not depend on them). Repeated rows stay repeated,
    ids may be null, other columns are ignored, an empty table gives no rows.
    """
    rows = docs.select(plain(id_col).alias("id"), plain(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = in_arrow(rows, lambda it: _encode(it, path, most_bytes, most_words), f"id {kind}, ids array<int>")
    return out.withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col`` and ``text``: the tokens joined by one space, special ones included (null ids: null)."""
    rows = tokens.select(plain(id_col).alias("id"), plain(ids_col).alias("ids"))
    kind = rows.schema["id"].dataType.simpleString()
    return in_arrow(rows, lambda it: _decode(it, path), f"id {kind}, text string").withColumnRenamed("id", id_col)
