"""Hashes of stretches of text, for whole arrays of stretches at once.

A stretch is a polynomial in its bytes at two random places modulo the prime 2^31 - 1, so two different
stretches of n bytes have equal hashes at no more than n of the 2^31 choices of each place, whatever their
bytes.  (Modulo 2^64 there are texts that collide at every place.)  Both values together are 62 bits.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

SEED = 5
#: Bytes for which powers are kept.
STRETCH = 1_000_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


PRIME = (1 << 31) - 1
_P = np.uint64(PRIME)


def modulo(x: np.ndarray) -> np.ndarray:
    """Values below 2^64 modulo the prime."""
    x = (x & _P) + (x >> np.uint64(31))
    x = (x & _P) + (x >> np.uint64(31))
    return np.where(x >= _P, x - _P, x)


def powers(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 to ``n``, modulo the prime."""
    out = np.ones(1, np.uint64)
    step = base
    while len(out) <= n:  # by doubling
        out = np.concatenate([out, modulo(out * np.uint64(step))])
        step = step * step % PRIME
    return out[: n + 1].astype(np.uint32)


@lru_cache(maxsize=1)
def _constants() -> list[tuple[np.ndarray, int, int, np.ndarray, np.ndarray]]:
    """For each of the two places: value of each byte, the place and its inverse, and their powers."""
    rng = np.random.default_rng(SEED)
    found = []
    for _ in range(2):
        value = rng.choice(1 << 20, 256, replace=False).astype(np.uint64) + np.uint64(1)
        base = int(rng.integers(1 << 24, PRIME - 1))
        inverse = pow(base, -1, PRIME)
        found.append((value, base, inverse, powers(base, STRETCH), powers(inverse, STRETCH)))
    return found


class Hashes:
    """Hashes of any stretch of a text, from two running sums."""

    def __init__(self, text: np.ndarray):
        self.totals, self.inverses = [], []
        for value, base, inverse, power, back in _constants():
            if len(text) > STRETCH:
                power, back = powers(base, len(text)), powers(inverse, len(text))
            terms = modulo(value[text] * power[: len(text)])
            # sums stay below 2^64: fewer than 2^33 bytes
            self.totals.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)]))
            self.inverses.append(back)

    def _of(self, start, end) -> np.ndarray:
        parts = [modulo(modulo(total[end] - total[start]) * back[start]) for total, back in zip(self.totals, self.inverses)]
        return mix(parts[0] << np.uint64(31) | parts[1])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self._of(start, end)

    def grams(self, size: int) -> np.ndarray:
        """Of the ``size`` bytes from each position on."""
        many = len(self.totals[0]) - size
        return self._of(slice(0, many), slice(size, size + many))
