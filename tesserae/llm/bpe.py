"""BPE by a pair occurrence index.

All distinct words of a partition's block lie end to end in one linked list of symbols. The index maps
each mergeable pair, by its rank, to all positions where it stands; a heap holds the active ranks. The
lowest active rank is applied at all its positions from left to right, and each merge enters the two
pairs that it makes into their lists. Positions that an earlier merge has changed are recognised when
their list is read. Work is proportional to the merges, so a word of any length is no special case.
"""

from __future__ import annotations

import heapq
import json

import numpy as np


def byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 stands for
    itself, the other bytes for the letters from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class PairIndex:
    def __init__(self, tokenizer):
        model = json.loads(tokenizer.to_str())["model"]
        self.vocab: dict[str, int] = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.pair = [(self.vocab[a], self.vocab[b], self.vocab[a + b]) for a, b in merges]
        self.rank = {a << 20 | b: r for r, (a, b, _) in reversed([*enumerate(self.pair)])}
        letters = byte_letters()
        self.inner = np.array([self.vocab.get(c, -1) for c in letters], np.int64)
        self.final = np.array([self.vocab.get(c + suffix, -1) for c in letters], np.int64)
        keys = np.fromiter(self.rank, np.int64, len(self.rank))
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], np.fromiter(self.rank.values(), np.int64, len(self.rank))[order]

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words end to end, and each word's count."""
        raw = [w.encode() for w in words]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        word = np.repeat(np.arange(len(raw)), size)
        symbols = self.inner[data]
        tail = np.cumsum(size) - 1
        symbols[tail] = self.final[data[tail]]
        known = symbols >= 0  # a letter outside the vocabulary has no id and is passed over
        symbols, word = symbols[known], word[known]
        self._merge(symbols, word)
        live = symbols >= 0
        return symbols[live].astype(np.uint32), np.bincount(word[live], minlength=len(words))

    def _merge(self, symbols: np.ndarray, word: np.ndarray) -> None:
        inside = word[1:] == word[:-1]
        lists, active = self._first_lists(symbols, inside)
        sym = symbols.tolist()
        after = np.where(np.append(inside, False), np.arange(1, len(sym) + 1), -1).tolist()
        before = np.where(np.append(False, inside)[: len(sym)], np.arange(-1, len(sym) - 1), -1).tolist()
        rank_of, pairs = self.rank.get, self.pair
        while active:
            r = heapq.heappop(active)
            a, b, made = pairs[r]
            places = lists.pop(r)
            places.sort()
            for p in places:
                if sym[p] != a or (q := after[p]) < 0 or sym[q] != b:
                    continue
                sym[p], sym[q] = made, -1
                after[p] = n = after[q]
                if n >= 0:
                    before[n] = p
                    if (k := rank_of(made << 20 | sym[n])) is not None:
                        if k in lists:
                            lists[k].append(p)
                        else:
                            lists[k] = [p]
                            heapq.heappush(active, k)
                if (m := before[p]) >= 0 and (k := rank_of(sym[m] << 20 | made)) is not None:
                    if k in lists:
                        lists[k].append(m)
                    else:
                        lists[k] = [m]
                        heapq.heappush(active, k)
        symbols[:] = sym

    def _first_lists(self, symbols: np.ndarray, inside: np.ndarray) -> tuple[dict[int, list[int]], list[int]]:
        at = np.flatnonzero(inside)
        key = symbols[at] << 20 | symbols[at + 1]
        k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[k] == key
        at, rank = at[hit], self.ranks[k[hit]]
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cut = np.flatnonzero(np.diff(rank)) + 1
        starts = np.concatenate(([0], cut)) if rank.size else np.empty(0, np.int64)
        lists = {int(rank[s]): part.tolist() for s, part in zip(starts.tolist(), np.split(at, cut))} if rank.size else {}
        return lists, sorted(lists)


class Decoder:
    """Ids back to text as the library's decode(ids, skip_special_tokens=False): byte-level vocabularies
    give their bytes, with U+FFFD for broken ones; without a decoder, tokens are joined by blanks."""

    def __init__(self, tokenizer):
        spec = json.loads(tokenizer.to_str())
        self.token = {i: t for t, i in tokenizer.get_vocab(with_added_tokens=True).items()}
        self.plain = spec["decoder"] is None
        self.byte = {c: b for b, c in enumerate(byte_letters())}

    def decode(self, ids: list[int]) -> str:
        tokens = [self.token[i] for i in ids if i in self.token]
        if self.plain:
            return " ".join(tokens)
        out = bytearray()
        for t in tokens:
            out += bytes(self.byte[c] for c in t) if all(c in self.byte for c in t) else t.encode()
        return out.decode("utf-8", "replace")
