"""64-bit hashes of substrings from running sums, for whole arrays at once."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
OTHER_BASE = np.uint64(0xD1342543DE82EF95)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 bits (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of ``symbols[start:end]`` for any spans; equal contents hash alike wherever they stand."""

    def __init__(self, symbols: np.ndarray, base: np.uint64 = _BASE):
        n = len(symbols)
        powers = np.full(n + 1, base, dtype=np.uint64)
        powers[0] = 1
        np.cumprod(powers, out=powers)
        self._sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * powers[:n], out=self._sums[1:])
        powers[1:] = np.uint64(pow(int(base), -1, 2**64))
        self._inverse = np.cumprod(powers, out=powers)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self._sums[end] - self._sums[start]) * self._inverse[start]
        return mixed(raw ^ (end - start).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        """The hashes of all ``k`` consecutive symbols."""
        if len(self._sums) <= k:
            return np.zeros(0, dtype=np.uint64)
        raw = (self._sums[k:] - self._sums[:-k]) * self._inverse[: len(self._sums) - k]
        return mixed(raw ^ np.uint64(k))
