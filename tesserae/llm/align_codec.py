"""Token ids whose bytes add up to the text, for a byte-level and a piece vocabulary.

Both encoders take the text with a space in front, cut it into words that no token crosses, and encode each
distinct word once. A word whose tokens' bytes differ from its own becomes the single id BAD.
"""

from __future__ import annotations

import numpy as np

from tesserae.llm.tokens import BYTE, Cutter, Encoder

#: No id of either vocabulary; ids travel as 16 bits.
BAD = 0xFFFF
#: Characters cut at once: a worker holds two vocabularies with their words, so its arrays are kept small.
SMALL_BLOCK = 1 << 18
SPACE_MARK = "▁"


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable ones stand for themselves, the others
    follow from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(c): b for c, b in [*zip(plain, plain), *zip(range(256, 512), rest)]}


def _checked(words: list[str], ids: np.ndarray, count: np.ndarray, table: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """ids and counts with BAD for words that aren't what their tokens say."""
    said = [table[i] for i in ids.tolist()]
    if b"".join(said) == "".join(words).encode() and np.array_equal(_sums(np.array([len(s) for s in said], np.int64), count), [len(w.encode()) for w in words]):
        return ids, count
    out, n, a = [], count.copy(), 0
    for k, w in enumerate(words):
        b = a + int(count[k])
        same = b > a and b"".join(said[a:b]) == w.encode()
        out.append(ids[a:b] if same else np.array([BAD], np.uint32))
        n[k] = len(out[-1])
        a = b
    return np.concatenate(out), n


def _sums(size: np.ndarray, count: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(size)))
    ends = np.cumsum(count)
    return total[ends] - total[ends - count]


class ByteAligned(Encoder):
    """A byte-level vocabulary in which the strings of special tokens are plain text."""

    block = SMALL_BLOCK

    def __init__(self, path: str):
        super().__init__(path, BYTE)
        self.tokenizer.encode_special_tokens = True
        self.special, letters = {}, byte_letters()
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.table = [bytes(letters[c] for c in t) if all(c in letters for c in t) else b"" for t in names]
        self.unseen = lambda words: _checked(words, *self._by_library(words), self.table)


class _PieceCutter(Cutter):
    """Words begin where a run of spaces or of line ends begins."""

    def __init__(self, lines: bool, spaces: bool):
        self.lines, self.spaces = lines, spaces

    def cut(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
        joined = "\0".join(texts) + "\0"
        code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))) - 1
        start = np.zeros(code.size + 1, bool)
        for sign, used in ((32, self.spaces), (10, self.lines and self.spaces)):
            if used:
                here = code == sign
                start[1:-1] |= here[1:] & ~here[:-1]
        start[0] = start[ends] = start[ends + 1] = True
        begin = np.flatnonzero(start[:-1])
        end, keep = np.append(begin[1:], code.size), np.ones(code.size, bool)
        keep[ends] = False
        keep = keep[begin]
        return *self._numbered(joined, code, begin, end, keep), np.diff(np.searchsorted(begin[keep], ends), prepend=0)


class PieceAligned(Encoder):
    """A piece vocabulary with byte fallback and no normalisation of its own, which puts a space in front of every
    text. Spaces within a piece only stand at its start, which the vocabulary is asked for."""

    block = SMALL_BLOCK

    def __init__(self, path: str):
        import sentencepiece

        self.model, self.kind, self.special = sentencepiece.SentencePieceProcessor(model_file=path), BYTE, {}
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.table = [bytes([int(t[3:5], 16)]) if self.model.is_byte(i) else t.replace(SPACE_MARK, " ").encode() for i, t in enumerate(names)]
        self.space = self.model.piece_to_id(SPACE_MARK)
        inner = any(SPACE_MARK in t.lstrip(SPACE_MARK) for t in names)
        self.cutter = _PieceCutter(lines=not any("\n" in t for t in names), spaces=not inner)
        self.unseen = lambda words: _checked(words, *self._by_model(words), self.table)
        self._forget()

    def _by_model(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The model adds a space of its own: it stands for the word's first one, or else is taken away."""
        got = self.model.encode([w[1:] if w[0] == " " else w for w in words], num_threads=1)
        for k, w in enumerate(words):
            if w == " ":
                got[k] = [self.space]
            elif w[0] != " ":
                got[k] = got[k][1:] if got[k][:1] == [self.space] else [BAD]
        count = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter((i for g in got for i in g), np.uint32, int(count.sum())), count


_kept: dict[tuple[str, str], Encoder] = {}


def aligned_encoder(path: str, side: str) -> Encoder:
    """This worker's encoder of side 'a' (byte-level) or 'b' (pieces)."""
    if (path, side) not in _kept:
        _kept[path, side] = (ByteAligned if side == "a" else PieceAligned)(path)
    return _kept[path, side]


def sizes(table: list[bytes]) -> np.ndarray:
    """Bytes of each id."""
    return np.array([len(t) for t in table], np.int64)
