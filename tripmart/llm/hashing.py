"""Hashes of spans of a sequence, whole arrays at a time."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15


_POWERS: list[np.ndarray] = []


def odd_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``n`` powers of an odd number and of its inverse, modulo 2**64; the most asked for are kept."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(1 << 16, n + n // 4)
        _POWERS.clear()
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            _POWERS.append(np.cumprod(row, out=row))
    return _POWERS[0], _POWERS[1]


def scramble(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of unsigned 64-bit integers; another one for each ``salt``."""
    x = x.astype(np.uint64)
    x += np.uint64((salt * _BASE + 0x1000003) % (1 << 64))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_keys(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit key of every span of ``values``: equal for equal content wherever it stands."""
    up, down = odd_powers(len(values))
    total = np.zeros(len(values) + 1, np.uint64)
    mixed = scramble(values)
    mixed *= up[: len(mixed)]
    np.cumsum(mixed, out=total[1:])
    del mixed
    return scramble((total[end] - total[begin]) * down[begin])
