"""64-bit hashes of any spans of a byte string, many at a time."""
from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_STEPS = (_BASE, pow(_BASE, -1, 1 << 64))
KEPT = 1 << 18  # powers kept between calls: 4 MB
_tables = [np.ones(1, dtype=np.uint64) for _ in _STEPS]

#: ASCII white space: 0x20 and 0x09 to 0x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int):
    """Powers 0 to ``n`` of both steps. A worker keeps ``KEPT`` of them; longer
    tables live as long as the spans that use them."""
    global _tables
    tables = _tables
    while len(tables[0]) <= n:
        m = len(tables[0])
        tables = [np.concatenate([t, t * np.uint64(pow(step, m, 1 << 64))]) for t, step in zip(tables, _STEPS, strict=True)]
        if len(tables[0]) <= KEPT:
            _tables = tables
    return tables


class ByteSpans:
    """Prefix sums of byte times power; a span's hash is their difference,
    moved to the origin and mixed with its length."""

    def __init__(self, data: bytes):
        self.data = np.frombuffer(data, dtype=np.uint8)
        power, self.inverse = _powers(len(data))
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=self.sums[1:])

    def hash(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.inverse[start] + (stop - start).astype(np.uint64))

    @staticmethod
    def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and stops of the maximal runs of True."""
        edge = np.flatnonzero(np.diff(np.r_[False, inside, False]))
        return edge[::2], edge[1::2]
