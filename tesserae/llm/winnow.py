"""Winnowing: which stretches of a text can hold a string of a given length that starts elsewhere too.

Every `span` consecutive hashes of `gram` bytes select their least one. Two equal strings select equal
hashes, so a string of `length` bytes that occurs twice selects only hashes that are selected at two
places or more. Nothing that repeats is lost; hashes that collide only let a stretch through. `widths` takes
gram and span in proportion to the length: shorter strings need more selected places.
"""

from __future__ import annotations

import numpy as np

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64, kept for the longest text so far."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        _POWERS[base] = tuple(np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)))) for b in (base, pow(base, -1, 1 << 64)))
    up, down = _POWERS[base]
    return up[:n], down[:n]


def gram_hashes(data: np.ndarray, gram: int, other: bool = False) -> np.ndarray:
    """A hash of data[i : i + gram] for each i, from prefix sums modulo 2^64. `other` takes another base."""
    n = len(data) - gram + 1
    up, down = _powers(len(data), 0xC2B2AE3D27D4EB4F if other else 0x9E3779B97F4A7C15)
    letters = np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    letters ^= letters >> np.uint64(31)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(letters[data] * up)))
    h = (sums[gram:] - sums[:n]) * down[:n]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    return h ^ h >> np.uint64(29)


def sliding(x: np.ndarray, w: int, op: np.ufunc, fill) -> np.ndarray:
    """op over x[i : i + w] for each i, from block prefixes and suffixes."""
    n = len(x)
    rows = -(-n // w)
    padded = np.full(rows * w, fill, x.dtype)
    padded[:n] = x
    grid = padded.reshape(rows, w)
    left = op.accumulate(grid, axis=1).ravel()
    right = op.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(right[: n - w + 1], left[w - 1 : n])


def selected(data: np.ndarray, gram: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window its least hash; and the hashes at all selected places."""
    h = gram_hashes(data, gram)
    least = sliding(h, span, np.minimum, np.iinfo(np.uint64).max)
    edge = np.full(span - 1, 0, np.uint64)
    most = sliding(np.concatenate((edge, least, edge)), span, np.maximum, 0)
    return least, h[h == most]


def among(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    """Whether each value is in a sorted array, by binary search."""
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    k = np.searchsorted(sorted_set, values)
    k[k == len(sorted_set)] = 0
    return sorted_set[k] == values


def widths(length: int) -> tuple[int, int]:
    """gram and span for strings of that length; more than half of it stays for the windows to agree in."""
    return length * 16 // 100, length * 40 // 100


def stretches(repeated: np.ndarray, length: int, gram: int, span: int) -> list[tuple[int, int]]:
    """Byte ranges that strings of `length` bytes can fill, given for each window whether its hash is
    selected elsewhere too."""
    need = length - (gram + span - 1) + 1
    edge = np.flatnonzero(np.diff(np.concatenate(([0], repeated.astype(np.int8), [0]))))
    return [(a, b + gram + span - 2) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()) if b - a >= need]
