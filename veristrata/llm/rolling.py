"""Polynomial hashes of all parts of a sequence, from one prefix sum (modulo 2**64)."""

from __future__ import annotations

import functools

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


@functools.lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    factors = np.full(size, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


def powers(base: int, n: int) -> np.ndarray:
    """The first n powers; kept for sizes that are powers of two, so that few tables are made."""
    return _powers(base, max(1 << 12, 1 << (max(n, 1) - 1).bit_length()))[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


class PrefixHash:
    """Hash of any part [a, b) of ``values``: the sum of values times powers, divided by the power of a."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(0x1F3D)) * powers(BASE, n), out=self.sums[1:])
        self.down = powers(INVERSE, n + 1)

    def part(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return (self.sums[last] - self.sums[first]) * self.down[first]

    def every(self, size: int) -> np.ndarray:
        """Hashes of all parts of one size."""
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        return (self.sums[size:] - self.sums[:n]) * self.down[:n]
