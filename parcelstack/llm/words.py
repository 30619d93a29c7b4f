"""Hashes of words and word windows over whole Arrow text columns, in numpy.

A word is a maximal run of bytes other than space and 0x09-0x0D. Its hash is a
polynomial in an odd base over random 64-bit codes of its bytes, taken from
running sums, then mixed; a window hashes the hashes of its words in order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .common import text_bytes

_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.array([_BYTE[b + 32] if 65 <= b <= 90 else _BYTE[b] for b in range(256)], dtype=np.uint64)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
# Bytes or words hashed at a time; memory follows this and the longest word, not the longest text.
BLOCK = 1 << 20
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2^64; kept
    for later calls up to the length of a block."""
    if n > BLOCK:
        return _table(n, _BASE), _table(n, _BASE_INV)
    if not _POWERS:
        _POWERS.extend(_table(BLOCK, base) for base in (_BASE, _BASE_INV))
    return _POWERS[0][:n], _POWERS[1][:n]


def _table(n: int, base: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit values (the finalizer of MurmurHash3)."""
    h = h ^ np.uint64(seed)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(col: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of words of each row); `lower` folds A-Z."""
    raw, offsets = text_bytes(col)
    n_rows = len(offsets) - 1
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(n_rows, np.int64)
    inside = ~_IS_SPACE[raw]
    first = np.unique(offsets[offsets < len(raw)])  # rows end words, too
    start = np.r_[inside[:1], inside[1:] & ~inside[:-1]]
    start[first] = inside[first]
    starts = np.flatnonzero(start)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(n_rows, np.int64)
    end = np.r_[~inside[1:], True] & inside
    end[first[first > 0] - 1] = inside[first[first > 0] - 1]
    ends = np.flatnonzero(end) + 1
    code = _LOWER if lower else _BYTE
    out = np.empty(len(starts), dtype=np.uint64)
    lo = 0
    while lo < len(starts):  # whole words, about a block of bytes at a time
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + BLOCK - 1, side="right")))
        at, a, b = starts[lo], starts[lo:hi], ends[lo:hi]
        n = int(b[-1] - at)
        power, inverse = _powers(n)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(code[raw[at:b[-1]]] * power, dtype=np.uint64, out=sums[1:])
        out[lo:hi] = mix((sums[b - at] - sums[a - at]) * inverse[a - at] + (b - a).astype(np.uint64) * _STEP)
        lo = hi
    return out, np.diff(np.searchsorted(starts, offsets))


def window_hashes(words: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hash of the `length` words from each word on, for every position of the
    flat array that has so many; rows are not told apart here."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, dtype=np.uint64)
    step = max(1, BLOCK - length)
    for lo in range(0, n, step):
        hi = min(n, lo + step)
        part = mix(words[lo:hi + length - 1], seed)
        power, inverse = _powers(len(part))
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(part * power, dtype=np.uint64, out=sums[1:])
        out[lo:hi] = mix((sums[length:] - sums[:-length]) * inverse[:hi - lo], length)
    return out


def whole_windows(counts: np.ndarray, length: int) -> np.ndarray:
    """Positions (in the flat array) from which `length` words lie in one row."""
    end = np.repeat(np.cumsum(counts), counts)
    at = np.arange(len(end))
    return at[at + length <= end]
