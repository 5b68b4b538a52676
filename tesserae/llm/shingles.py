"""Word shingles and MinHash signatures of many documents at once, on UTF-8 bytes."""

from __future__ import annotations

import numpy as np

ODD = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 output bits."""
    x = x ^ x >> np.uint64(33)
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, lower-cased in A-Z, and each text's count of words."""
    data = _LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    blank = _BLANK[data]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    begin = edge[::2] if blank[0] else np.concatenate(([0], edge[1::2]))
    end = edge[1::2] if blank[0] else edge[::2]
    if not len(end):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    begin = begin[: len(end)]
    size = end - begin
    power = np.cumprod(np.full(int(size.max()), ODD, np.uint64))
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    letter = mix(np.arange(1, 257, dtype=np.uint64))[data[np.repeat(begin, size) + at]]
    sums = np.add.reduceat(letter * power[at], np.cumsum(size) - size)
    return mix(sums + size.astype(np.uint64)), np.diff(np.searchsorted(begin, ends), prepend=0)


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's k-word shingles; of all its words, if it has fewer."""
    word, count = words(texts)
    n = len(word)
    pad = np.concatenate((word, np.zeros(k, np.uint64)))
    whole = np.zeros(n, np.uint64)
    for j in range(k):
        whole = mix(whole + pad[j : n + j] + np.uint64(j + 1))
    out, a = [], 0
    for c in count.tolist():
        if c >= k:
            out.append(np.unique(whole[a : a + c - k + 1]))
        elif c:
            short = np.zeros(1, np.uint64)
            for w in word[a : a + c]:
                short = mix(short * ODD + w)
            out.append(short)
        else:
            out.append(np.empty(0, np.uint64))
        a += c
    return out


def signatures(sets: list[np.ndarray], n: int) -> np.ndarray:
    """n MinHash values (32 bits) of each set; all ones for an empty one."""
    out = np.full((len(sets), n), 0xFFFFFFFF, np.uint32)
    full = [i for i, s in enumerate(sets) if len(s)]
    if not full:
        return out
    flat = np.concatenate([sets[i] for i in full])
    at = np.concatenate(([0], np.cumsum([len(sets[i]) for i in full])[:-1]))
    seeds = mix(np.arange(1, 2 * n + 1, dtype=np.uint64)).reshape(2, n)
    for j in range(n):
        h = (flat ^ seeds[0, j]) * (seeds[1, j] | np.uint64(1))
        h ^= h >> np.uint64(29)
        h *= ODD
        out[full, j] = np.minimum.reduceat(h >> np.uint64(32), at)
    return out


def jaccard_at_least(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, for sorted distinct arrays that aren't both empty."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    if len(a) > len(b):
        a, b = b, a
    k = np.searchsorted(b, a)
    k[k == len(b)] = 0
    common = int(np.count_nonzero(b[k] == a)) if len(b) else 0
    return 100 * common >= percent * (len(a) + len(b) - common) and common > 0
