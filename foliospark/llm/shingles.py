"""Word and shingle hashes in numpy (64 bits)."""

from __future__ import annotations

import numpy as np
from xxhash import xxh3_64_intdigest

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of k word hashes (k at most 8)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = h[:n] * _ODD[0]
    for d in range(1, k):
        out = mixed(out) + h[d : d + n] * _ODD[d]
    return mixed(out)


def run_hashes(h: np.ndarray, starts: np.ndarray, lengths) -> np.ndarray:
    """Hashes of the runs h[s : s + l], by prefix sums of a polynomial modulo 2**64 with an odd base."""
    n = len(h)
    powers, inverse = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed(h) * powers[:n], out=sums[1:])
    return mixed((sums[starts + lengths] - sums[starts]) * inverse[starts] + np.atleast_1d(np.asarray(lengths, np.uint64)) * _ODD[1])


_cache = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _cache
    if len(_cache[0]) < n:
        base = 0x9E3779B97F4A7C15
        back = pow(base, -1, 1 << 64)
        size = max(n, 65536)
        _cache = tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, b, np.uint64)]), dtype=np.uint64) for b in (base, back))
    return _cache
