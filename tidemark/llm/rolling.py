"""Vectorised hashing of many texts at once: byte grams, words and word runs as 64-bit numbers.

Texts lie one after another in a byte array. A prefix sum of byte values times powers of a fixed odd base gives the
hash of any slice with two lookups and one multiplication, all modulo 2**64.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE = 0x9E6F4A7D3B8C51E5
INVERSE = pow(BASE, -1, 2**64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_VALUES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) | U(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i up to n; kept by the process."""
    if len(_powers[0]) <= n:
        size = max(1 << 16, 1 << int(n).bit_length())
        for k, b in enumerate((BASE, INVERSE)):
            steps = np.full(size, b, U)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=U)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


class Slices:
    """Hashes of slices of one sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        up, self.down = powers(n + 1)
        self.sums = np.zeros(n + 1, U)
        np.cumsum(values * up[:n], dtype=U, out=self.sums[1:])

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(self.raw(start, end) + (end - start).astype(U) * U(0xD6E8FEB86659FD93))

    def every(self, length: int) -> np.ndarray:
        """Of all slices of this length, in order."""
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, U)
        x = self.sums[length:] - self.sums[:n]
        x *= self.down[:n]
        return mix(x)


class Texts:
    """Texts in one byte array; offsets has one more entry than there are texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def byte_slices(self) -> Slices:
        return Slices(_VALUES[self.data])

    def words(self, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of all words in order: hash, start, end; and where each text's words begin (one more entry than texts)."""
        n = len(self.data)
        if not n:
            return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(self.offsets), np.int64)
        inside = ~_SPACE[self.data]
        cut = np.zeros(n + 1, bool)
        cut[self.offsets] = True
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1] | cut[1:n]
        last[:-1] &= ~inside[1:] | cut[1:n]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        data = _LOWER[self.data] if lower else self.data
        return Slices(_VALUES[data]).of(start, end), start, end, np.searchsorted(start, self.offsets)


def fits(begins: np.ndarray, length: int, total: int) -> np.ndarray:
    """For each place, whether a run of this length from there stays inside its text."""
    ok = np.zeros(max(total - length + 1, 0), bool)
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
        if b - a >= length:
            ok[a : b - length + 1] = True
    return ok


def minimizers(keys: np.ndarray, window: int) -> np.ndarray:
    """For each start of a window of keys, the place of its smallest key; of equal ones the leftmost."""
    n = len(keys)
    if n < window:
        return np.zeros(0, np.int64)
    bits = U(int(n).bit_length())
    packed = ((keys >> bits) << bits) | np.arange(n, dtype=U)
    size = -(-n // window) * window
    grid = np.full(size, U(2**64 - 1))
    grid[:n] = packed
    grid = grid.reshape(-1, window)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[: n - window + 1], ahead[window - 1 : n])
    return (least & ((U(1) << bits) - U(1))).astype(np.int64)
