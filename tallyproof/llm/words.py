"""Words of UTF-8 texts as numpy arrays: positions and 64-bit hashes, without a Python loop per word.

A word is a maximal run of bytes other than space, tab, newline, vertical tab, form feed and
carriage return. All of these are single bytes in UTF-8, so words can be cut on bytes.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
from typing import NamedTuple

import numpy as np

SPAN = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray


def mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


@lru_cache(1)
def byte_values() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * BASE)


@lru_cache(2)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE to the powers 0 to n-1, and to their negatives, modulo 2**64."""
    with np.errstate(over="ignore"):
        up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, BASE)]).astype(np.uint64))
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, inverse)]).astype(np.uint64))
    return up, down


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of ``data[start:end]`` for ascending ranges of one buffer."""
    if not len(start):
        return np.empty(0, np.uint64)
    first, n = int(start[0]), int(end[-1] - start[0])
    up, down = powers(1 << max(20, (n - 1).bit_length()))
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(byte_values()[data[first : first + n]] * up[:n], out=total[1:])
        sums = (total[end - first] - total[start - first]) * down[start - first]
        return mixed(sums + (end - start).astype(np.uint64) * BASE)


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """Words of the rows that ``offsets`` cuts out of ``data``; ``lower`` folds A to Z only."""
    if lower:
        data = LOWER[data]
    n = len(data)
    if not n:
        empty = np.empty(0, np.int64)
        return Words(empty, empty, empty, np.empty(0, np.uint64))
    gap = SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    left = cut[:-1].copy()
    left[1:] |= gap[:-1]
    right = cut[1:].copy()
    right[:-1] |= gap[1:]
    start, end = np.flatnonzero(~gap & left), np.flatnonzero(~gap & right) + 1
    row = np.searchsorted(offsets, start, "right") - 1
    return Words(start, end, row, span_hashes(data, start, end))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``range_hashes`` of any number of ascending ranges, a bounded stretch of bytes at a time."""
    hashes, i = np.empty(len(start), np.uint64), 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + SPAN, "right")))
        hashes[i:j] = range_hashes(data, start[i:j], end[i:j])
        i = j
    return hashes


def sums(hashes: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Hash of the words first to last (exclusive), for arrays of ranges."""
    n = len(hashes)
    up, down = powers(1 << max(20, n.bit_length()))
    with np.errstate(over="ignore"):
        total = np.concatenate([[np.uint64(0)], np.cumsum(hashes * up[:n], dtype=np.uint64)])

    def ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((total[last] - total[first]) * down[first] + (last - first).astype(np.uint64) * BASE)

    return ranges


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Order-sensitive hash of each run of ``n`` consecutive word hashes."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    size = len(hashes) - n + 1
    with np.errstate(over="ignore"):
        out = hashes[:size].copy()
        for j in range(1, n):
            out = out * BASE + hashes[j : j + size]
    return mixed(out)


def code_points(data: np.ndarray) -> np.ndarray:
    """Code points before each byte position (one more entry than bytes)."""
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=total[1:])
    return total
