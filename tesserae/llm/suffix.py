"""Suffix array and common prefixes of one shard, in numpy."""

from __future__ import annotations

import numpy as np

#: Positions are packed into sort keys with this many bits.
POSITION_BITS = 21
MOST = (1 << POSITION_BITS) - 1


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Larsson-Sadakane: suffixes sorted by their first letters form groups, and each round sorts the
    groups that have more than one member by the group that stands h letters on, doubling h. Sorted
    groups aren't touched again. A round is one sort of 64-bit keys (group, group at h, place)."""
    n = len(data)
    if n > MOST:
        raise ValueError(f"a shard has at most {MOST} letters")
    used = np.unique(data)
    letter = np.zeros(256, np.int64)
    letter[used] = np.arange(1, len(used) + 1)
    bits = int(len(used)).bit_length()
    h = max(1, (62 - POSITION_BITS) // bits)
    codes = np.concatenate((letter[data], np.zeros(h, np.int64)))
    key = np.zeros(n, np.int64)
    for j in range(h):
        key = key << bits | codes[j : n + j]
    packed = np.sort(key << POSITION_BITS | np.arange(n))
    order = packed & MOST
    key = packed >> POSITION_BITS
    new = np.concatenate((np.ones(1, bool), key[1:] != key[:-1]))[:n]
    # group[i]: place of the first member of suffix i's group, from 1; 0 stands past the end
    group = np.zeros(n + 1, np.int64)
    first = np.maximum.accumulate(np.where(new, np.arange(1, n + 1), 0))
    group[order] = first
    open_ = np.flatnonzero(~(new & np.concatenate((new[1:], np.ones(1, bool)))[:n]))
    while len(open_):
        members = order[open_]
        own = group[members]
        ahead = group[np.minimum(members + h, n)]
        # groups are renumbered among the open ones, so that three fields fit a key
        part = np.cumsum(np.concatenate((np.zeros(1, np.int64), (own[1:] != own[:-1]).astype(np.int64))))
        packed = np.sort((part << POSITION_BITS | ahead) << POSITION_BITS | np.arange(len(open_)))
        members = members[packed & MOST]
        pair = packed >> POSITION_BITS
        order[open_] = members
        new = np.concatenate((np.ones(1, bool), pair[1:] != pair[:-1]))
        group[members] = np.maximum.accumulate(np.where(new, open_ + 1, 0))
        open_ = open_[~(new & np.concatenate((new[1:], np.ones(1, bool))))]
        h *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Kasai: for each place k of the order, the letters that suffixes order[k - 1] and order[k] share.

    In text order a suffix shares at least one letter fewer than the suffix before it, and exactly that
    where the letters before both are equal. So only the other places are compared, eight letters at a
    time, and the rest follow from a running maximum."""
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    i = np.arange(n)
    known = (before > 0) & (i > 0)
    known[known] = data[i[known] - 1] == data[before[known] - 1]
    at = np.flatnonzero(~known & (before >= 0))
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eight = np.lib.stride_tricks.as_strided(padded, (n, 8), (1, 1)).copy().view("<u8").ravel()
    shared = np.zeros(n, np.int64)
    a, b, live = at.copy(), before[at].copy(), np.arange(len(at))
    out = np.zeros(len(at), np.int64)
    while len(live):
        room = n - np.maximum(a, b)
        same = (eight[np.minimum(a, n - 1)] == eight[np.minimum(b, n - 1)]) & (room >= 8)
        out[live[same]] += 8
        end = ~same
        for k in range(8):
            if not end.any():
                break
            x, y = a[end], b[end]
            ok = (k < n - np.maximum(x, y)) & (padded[np.minimum(x + k, n)] == padded[np.minimum(y + k, n)])
            out[live[np.flatnonzero(end)[ok]]] += 1
            end[np.flatnonzero(end)[~ok]] = False
        a, b, live = a[same] + 8, b[same] + 8, live[same]
    shared[at] = out
    reach = np.where(known, 0, shared + i)
    reach = np.maximum.accumulate(reach)
    shared = np.where(before >= 0, np.maximum(reach - i, 0), 0)
    return shared[order]
