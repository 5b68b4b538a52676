"""Whole-text tokenisation at array speed.

Texts are cut into words for thousands of documents at once with numpy (character classes, run
boundaries, contractions), every distinct word is encoded once, and ids are gathered by index. The
result equals the tokenizers library's on whole texts: character classes are asked from the library's
own pre-tokenizer, and words that share a hash are compared character by character.

Two vocabularies are understood: byte-level BPE with the usual word pattern (`BYTE`), whose unseen
words the library encodes, and lower-cased word BPE with word ends (`WORD`), whose unseen words go
through the pair index of `tesserae.llm.bpe`.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from tokenizers import Tokenizer

BYTE, WORD = "byte", "word"
LETTER, NUMBER, OTHER, BLANK, END, UNKNOWN = 0, 1, 2, 3, 4, 255
#: Characters cut at once, which bounds memory; words kept from earlier blocks.
BLOCK, KEPT_WORDS = 1 << 20, 400_000


class Cutter:
    """Cuts texts into the words of a pre-tokenizer and numbers the distinct ones."""

    def __init__(self, pre_tokenizer, kind: str):
        self.pre, self.kind = pre_tokenizer, kind
        self.table = np.full(0x110000, UNKNOWN, np.uint8)

    def _class_of(self, code: int) -> int:
        ch = chr(code)
        pieces = lambda probe: [span for _, span in self.pre.pre_tokenize_str(probe)]
        if (0, 3) in pieces(f"x{ch}x"):
            return LETTER
        if (0, 3) in pieces(f"!{ch}!"):
            return OTHER
        if self.kind == WORD:
            return NUMBER if any(a <= 1 < b for a, b in pieces(f"x{ch}x")) else BLANK
        return NUMBER if (0, 3) in pieces(f"1{ch}1") else BLANK

    def _classes(self, codes: np.ndarray) -> np.ndarray:
        out = self.table[codes]
        if (new := codes[out == UNKNOWN]).size:
            for code in np.unique(new).tolist():
                self.table[code] = self._class_of(code)
            out = self.table[codes]
        return out

    def cut(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
        """Word number of each word in order, the distinct words, and each text's count of words."""
        joined = "\0".join(texts) + "\0"
        code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))) - 1
        kind = self._classes(code)
        kind[ends] = END
        first = np.concatenate(([0], np.flatnonzero(kind[1:] != kind[:-1]) + 1))
        last, of = np.append(first[1:], code.size), kind[first]
        start = np.zeros(code.size, bool)
        start[first] = True
        if self.kind == BYTE:  # of white space before a word, the last blank joins the word
            runs = np.flatnonzero(of == BLANK)
            runs = runs[of[runs + 1] != END]
            at = last[runs] - 1
            start[at] = True
            start[last[runs[code[at] == 32]]] = False
        else:
            start[kind == NUMBER] = True
        self._contractions(code, kind, first, last, of, start)
        begin = np.flatnonzero(start)
        end = np.append(begin[1:], code.size)
        keep = kind[begin] != END
        if self.kind == WORD:
            keep &= kind[begin] != BLANK
        return *self._numbered(joined, code, begin, end, keep), np.diff(np.searchsorted(begin[keep], ends), prepend=0)

    def _numbered(self, joined: str, code: np.ndarray, begin: np.ndarray, end: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, list[str]]:
        """A number for each word that is kept, and the distinct words."""
        sums = self._sums(code, begin, end)[keep]
        begin, end = begin[keep], end[keep]
        number, distinct = pd.factorize(sums)
        lead = np.empty(len(distinct), np.int64)
        lead[number[::-1]] = np.arange(len(number) - 1, -1, -1)
        if not self._same(code, begin, end, lead[number]):
            number, lead = self._by_text(joined, begin, end)
        return number, [joined[a:b] for a, b in zip(begin[lead].tolist(), end[lead].tolist())]

    @staticmethod
    def _contractions(code, kind, first, last, of, start) -> None:
        """'s 't 'm 'd 're 've 'll are words where an apostrophe of its own begins one."""
        run = np.flatnonzero((of[:-1] == OTHER) & (of[1:] == LETTER))
        at = first[run]
        ok = (last[run] - at == 1) & (code[at] == 39) & start[at]
        at, letters = at[ok], (last - first)[run[ok] + 1]
        c, d = code[at + 1], code[np.minimum(at + 2, code.size - 1)]
        one = (c == 115) | (c == 116) | (c == 109) | (c == 100)
        two = (letters > 1) & (((c == 114) & (d == 101)) | ((c == 118) & (d == 101)) | ((c == 108) & (d == 108)))
        start[at[one | two] + 1] = False
        start[at[one] + 2] = True
        start[at[two] + 3] = True

    @staticmethod
    def _sums(code, begin, end) -> np.ndarray:
        size = end - begin
        with np.errstate(over="ignore"):
            power = np.cumprod(np.full(int(size.max()), 0x9E3779B97F4A7C15, np.uint64))
            mixed = (code.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(32)
            mixed *= power[np.arange(code.size) - np.repeat(begin, size)]
            return np.add.reduceat(mixed, begin)

    @staticmethod
    def _same(code, begin, end, lead) -> bool:
        size = end - begin
        if not np.array_equal(size, size[lead]):
            return False
        if not size.size:
            return True
        own = np.repeat(begin - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(int(size.sum()))
        return np.array_equal(code[own], code[own + np.repeat(begin[lead] - begin, size)])

    @staticmethod
    def _by_text(joined, begin, end):
        seen: dict[str, int] = {}
        lead, number = [], np.empty(len(begin), np.int64)
        for i, (a, b) in enumerate(zip(begin.tolist(), end.tolist())):
            k = seen.setdefault(joined[a:b], len(seen))
            if k == len(lead):
                lead.append(i)
            number[i] = k
        return number, np.array(lead, np.int64)


def _lower(text: str) -> str:
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class Encoder:
    """encode(texts) gives all ids in one array and where each text's ids begin."""

    block = BLOCK

    def __init__(self, path: str, kind: str = BYTE):
        self.tokenizer, self.kind = Tokenizer.from_file(path), kind
        self.cutter = Cutter(self.tokenizer.pre_tokenizer, kind)
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        if kind == WORD:
            from tesserae.llm.bpe import PairIndex

            self.unseen: Callable = PairIndex(self.tokenizer).encode
        else:
            self.unseen = self._by_library
        self.lowered, self.odd = set(" \t\n\x0b\x0c\r"), set()  # white space is dropped in any form
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.ids, self.at, self.count = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _by_library(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, count = [], []
        for i in range(0, len(words), 20_000):
            part = words[i : i + 20_000]
            got = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(got.ids, np.uint32))
            count.append(np.bincount(np.array(got.word_ids, np.int64), minlength=len(part)))
        return np.concatenate(ids), np.concatenate(count)

    def _slots(self, words: list[str]) -> np.ndarray:
        if len(self.slot) > KEPT_WORDS:
            self._forget()
        slot = self.slot
        if new := [w for w in words if w not in slot]:
            ids, count = self.unseen(new)
            slot.update(zip(new, range(len(slot), len(slot) + len(new))))
            self.at = np.concatenate((self.at, self.ids.size + np.cumsum(count) - count))
            self.count, self.ids = np.concatenate((self.count, count)), np.concatenate((self.ids, ids))
        return np.fromiter(map(slot.__getitem__, words), np.int64, len(words))

    def _normal(self, text: str) -> str:
        """The library's normal form. Letters that it lowers otherwise than Python (it may know another
        edition of Unicode) are found by asking it once for each letter."""
        if self.kind == BYTE:
            return text
        if text.isascii():
            return text.lower()
        letters = set(text)
        for ch in letters - self.lowered:
            self.lowered.add(ch)
            if self.tokenizer.normalizer.normalize_str(ch) != _lower(ch):
                self.odd.add(ch)
        return _lower(text) if letters.isdisjoint(self.odd) else self.tokenizer.normalizer.normalize_str(text)

    def _pieces(self, text: str) -> Iterator[tuple[str, int]]:
        """The text's parts between special tokens, with the id after each or -1. Very long parts are
        cut before white space that follows a word, where no word ever crosses."""
        while hits := [(k, s) for s in self.special if (k := text.find(s)) >= 0]:
            k, s = min(hits, key=lambda h: (h[0], -len(h[1])))
            yield from self._short(text[:k], self.special[s])
            text = text[k + len(s) :]
        yield from self._short(text, -1)

    def _short(self, text: str, after: int) -> Iterator[tuple[str, int]]:
        a = 0
        while len(text) - a > self.block:
            b = text.find(" ", a + self.block // 2)
            while b > 0 and text[b - 1].isspace():
                b = text.find(" ", b + 1)
            if b < 0:
                break
            yield self._normal(text[a:b]), -1
            a = b
        yield self._normal(text[a:]), after

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        pieces, owner, after = [], [], []
        for i, t in enumerate(texts):
            for piece, special in self._pieces(t or ""):
                pieces.append(piece)
                owner.append(i)
                after.append(special)
        parts, sizes, a = [], np.zeros(len(texts), np.int64), 0
        while a < len(pieces):
            b, chars = a, 0
            while b < len(pieces) and (b == a or chars + len(pieces[b]) <= self.block):
                chars += len(pieces[b])
                b += 1
            ids, count = self._block(pieces[a:b])
            extra = np.array(after[a:b])
            if (extra >= 0).any():
                ids = np.insert(ids, np.cumsum(count)[extra >= 0], extra[extra >= 0].astype(np.uint32))
                count = count + (extra >= 0)
            np.add.at(sizes, owner[a:b], count)
            parts.append(ids)
            a = b
        flat = np.concatenate(parts) if parts else np.empty(0, np.uint32)
        return flat, np.concatenate(([0], np.cumsum(sizes)))

    def _block(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        number, words, per_text = self.cutter.cut(pieces)
        slots = self._slots(words)[number]
        count = self.count[slots]
        total = np.concatenate(([0], np.cumsum(count)))
        ids = self.ids[np.repeat(self.at[slots] - total[:-1], count) + np.arange(int(total[-1]))]
        bounds = np.concatenate(([0], np.cumsum(per_text)))
        return ids, np.diff(total[bounds])


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, kind: str = BYTE) -> Encoder:
    """This worker's encoder; its words are kept from task to task."""
    if (path, kind) not in _encoders:
        _encoders[path, kind] = Encoder(path, kind)
    return _encoders[path, kind]


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
