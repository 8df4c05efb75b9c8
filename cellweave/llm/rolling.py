"""Array arithmetic for hashes of byte strings: any substring's hash from prefix sums.

The hash of bytes ``x[i:j]`` is ``sum(R[x[t]] * B**(t - i))`` modulo 2**64, taken
from one running sum of ``R[x[t]] * B**t`` and the inverse power of ``B``.  The
low bits of such a sum are weak, so every hash is mixed before use.
"""

from __future__ import annotations

import functools

import numpy as np

_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


@functools.lru_cache(maxsize=4)
def _table(which: int) -> np.ndarray:
    return np.random.default_rng(1234 + which).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        have[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(have)
        if len(have) > 1 << 24:
            del _POWERS[base]
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Rolling:
    """Hashes of substrings of one byte array."""

    def __init__(self, data: np.ndarray, which: int = 0) -> None:
        self.base = _BASES[which]
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_table(which)[data] * _powers(self.base, len(data)), out=self.sums[1:])
        self.inverse = _powers(pow(self.base, -1, 1 << 64), len(data) + 1)

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.inverse[start])


def distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct keys; sorting beats a hash table by far here."""
    keys = np.sort(keys)
    return keys[np.diff(keys, prepend=~keys[:1]) != 0] if len(keys) else keys


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and each key's place among them."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.diff(keys, prepend=~keys[:1]) != 0 if len(keys) else np.zeros(0, dtype=bool)
    place = np.empty(len(keys), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    return keys[new], place
