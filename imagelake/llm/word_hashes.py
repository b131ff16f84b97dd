"""Hashes of all words, and of all windows of words, of a text as NumPy arrays."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Bytes whose words are hashed at once.
STRETCH = 1 << 17
_SOLID = ~np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
#: Random numbers per byte value, one table per independent hash.
_OF_BYTE = np.random.default_rng(20240229).integers(0, 2 ** 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 0x9FB21C651E98DF25
_ODD = 0xD6E8FEB86659FD93


@lru_cache(maxsize=1)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n - 1 of _STEP and of its inverse, modulo 2**64."""
    both = []
    for x in (_STEP, pow(_STEP, -1, 2 ** 64)):
        p = np.full(n, x, np.uint64)
        p[0] = 1
        both.append(np.cumprod(p, dtype=np.uint64))
    return both[0], both[1]


def word_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of ``data`` (bytes) begins and ends."""
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = _SOLID[data]
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    return edges[::2], edges[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """64-bit hash of each word of ``data`` (bytes): a polynomial modulo 2**64 over one random
    number per byte value, then mixed. ``which`` (0 or 1) chooses the numbers."""
    h = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        first = starts[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, first + STRETCH, "right")))
        n = int(ends[hi - 1] - first)
        up, down = powers(max(n, STRETCH))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_OF_BYTE[which][data[first:first + n]] * up[:n], dtype=np.uint64, out=sums[1:])
        s = starts[lo:hi] - first
        h[lo:hi] = (sums[ends[lo:hi] - first] - sums[s]) * down[s]
        lo = hi
    h ^= h >> np.uint64(32)
    h *= np.uint64(_ODD)
    return h ^ (h >> np.uint64(29))


def rolling(hashes: np.ndarray, length: int, odd: int) -> np.ndarray:
    """Hash of each window of ``length`` entries: a polynomial modulo 2**64, then mixed."""
    n = len(hashes)
    if n < length:
        return np.empty(0, np.uint64)
    up = np.full(n, odd, np.uint64)
    up[0] = 1
    down = np.full(n, pow(odd, -1, 2 ** 64), np.uint64)
    down[0] = 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * np.cumprod(up, dtype=np.uint64), dtype=np.uint64, out=sums[1:])
    h = (sums[length:] - sums[:-length]) * np.cumprod(down, dtype=np.uint64)[:n - length + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))
