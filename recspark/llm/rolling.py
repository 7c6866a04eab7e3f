"""Vectorised string fingerprints shared by the operators (helpers that run inside tasks).

A polynomial fingerprint modulo 2^64 with an odd base has an invertible base, so the
fingerprint of any slice of a buffer is a difference of two prefix sums.
"""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
MASK = (1 << 64) - 1
U = np.uint64

_POW: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept per worker and grown by doubling."""
    have = _POW.get(base)
    if have is None or len(have) < n:
        out = np.ones(1, dtype=U)
        while len(out) < max(n, 1 << 12):
            out = np.concatenate([out, out * U(pow(base, len(out), 1 << 64))])
        _POW[base] = have = out
    return have[:n]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser; different seeds give unrelated values."""
    x = x + U((seed * 0xD1B54A32D192ED03 + 0x8CB92BA72F3D8DD7) & MASK)
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(29)
    x *= U(0xA0761D6478BD642F)
    x ^= x >> U(32)
    return x


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    """h with h[j] - h[i] = sum of (byte + 1) * BASE^k over i <= k < j."""
    h = np.empty(len(raw) + 1, dtype=U)
    h[0] = 0
    v = raw.astype(U)
    v += U(1)
    v *= powers(BASE, len(raw))
    np.cumsum(v, out=h[1:])
    return h


def slices(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-free fingerprints of raw[start:end] from prefix sums."""
    return (h[end] - h[start]) * powers(INVERSE, len(h))[start]


def fingerprints(codes: np.ndarray, start: np.ndarray, end: np.ndarray, span: int = 1 << 17) -> np.ndarray:
    """Fingerprint of each ordered, disjoint slice codes[start:end]; in spans, so that work arrays stay small."""
    out = np.empty(len(start), dtype=U)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + span, side="right")))
        lo = int(start[i])
        h = prefix_sums(codes[lo:int(end[j - 1])])
        s, e = start[i:j] - lo, end[i:j] - lo
        out[i:j] = mix(slices(h, s, e) + (e - s).astype(U) * U(0xBF58476D1CE4E5B9))
        i = j
    return out


SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BLOCK = 1 << 18


def words(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint and start of each maximal run of bytes outside space and 0x09-0x0D."""
    b = np.frombuffer(raw, dtype=np.uint8)
    hs, ss, at = [], [], 0
    while at < len(b):
        end = min(len(b), at + BLOCK)
        while end < len(b) and not SPACE[b[end]]:  # a block ends between words
            gap = np.flatnonzero(SPACE[b[end:end + BLOCK]])
            end = end + int(gap[0]) if len(gap) else min(len(b), end + BLOCK)
        part = b[at:end]
        out = ~SPACE[part]
        edge = np.diff(np.concatenate([[False], out, [False]]).astype(np.int8))
        s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        hs.append(mix(slices(prefix_sums(part), s, e) + (e - s).astype(U) * U(0xBF58476D1CE4E5B9)))
        ss.append(s + at)
        at = end
    if not hs:
        return np.zeros(0, dtype=U), np.zeros(0, dtype=np.int64)
    return np.concatenate(hs), np.concatenate(ss).astype(np.int64)
