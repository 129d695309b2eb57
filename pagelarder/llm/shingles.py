"""Word and shingle hashes of whole texts, in numpy."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

# Executors need no copy of this package: the functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SEGMENT = 1 << 20  # bytes hashed at once, which bounds the working arrays
_BASE = 0x9E3779B97F4A7C15
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_LOWER += np.uint64(1)
_powers: list[np.ndarray] = []


def _tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < size:
        n = max(size, 1 << 14)
        _powers.clear()
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            factors = np.full(n, base, np.uint64)
            factors[0] = 1
            _powers.append(np.cumprod(factors, dtype=np.uint64))
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of every word in order, letters A-Z in lower case."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    found, start = [], 0
    while start < len(data):
        stop = min(start + _SEGMENT, len(data))
        while stop < len(data) and not _IS_SPACE[data[stop]]:
            gap = np.flatnonzero(_IS_SPACE[data[stop : stop + _SEGMENT]])
            stop = stop + int(gap[0]) if len(gap) else min(stop + _SEGMENT, len(data))
        found.append(_hash_words(data[start:stop]))
        start = stop
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def _hash_words(data: np.ndarray) -> np.ndarray:
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_IS_SPACE[data]
    edge = np.flatnonzero(np.diff(inside))
    first, last = edge[::2], edge[1::2]
    power, inverse = _tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LOWER[data] * power[: len(data)], out=total[1:])
    return mix((total[last] - total[first]) * inverse[first])


def shingle_set(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of `size` consecutive words; a shorter text is one shingle."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    width = min(n, size)
    combined = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        combined = combined * np.uint64(_BASE) + words[k : k + n - width + 1]
    return np.unique(mix(combined))
