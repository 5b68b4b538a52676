"""Toxicity of restored text: a noisy channel undoes disguises, then learnt words are looked up.

Letters may be written as look-alike signs, spelt with gaps or stretched. Where a text shows one of
these (a token with a letter and a sign, three equal letters in a row, single letters in a row), the stretch
becomes a lattice of letters: each sign stands for any of its readings, for itself, or for nothing; in
runs of 2 to MASK stars each stands for any letter. A Viterbi search takes the likeliest path under a
trigram model of letters times the channel's costs, for all stretches of a batch at once. Stretches of more
than LONG characters are cut where two characters have one reading only, which leaves the path no choice;
where they have no such place, a search of their own passes on what all paths have in common. Either way the reading is that of the
whole stretch. A stretch without a sign between letters, at the start
of a word or four letters in a row may as well be a code or plain: its reading is added to it, and doesn't
replace it. Everything else has one path and stays as it is.

The letter model is counted over all documents. Words and word beginnings are learnt from labelled
rows: those in a share of at least SUPPORT of the toxic rows, whose odds differ from clean rows by
enough. A logistic regression sums the evidence of all of a text's features; its ridge penalty shrinks
weights with little support. At most TRAIN_ROWS labelled rows are used, those with the smallest hash of
their identifier, so that the labels can be sent to every task; a feature needs a fixed share of the
toxic rows, which bounds their number by the words of an average document over SUPPORT. The driver gets
counts of features and the distinct sets of telling features, at most one for each labelled row.

Null and empty texts have no features and score as such. Repeated rows get equal scores; labels, lang,
source and doc_id are not read in scoring. Without labelled rows of both kinds every score is 0.
Columns are read by name and no column is added to the rows in `without_toxic`, so that extra columns of
any name pass through.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm.common import drop, map_texts, returning, small_batches, store

TRAIN_ROWS, SUPPORT, FOLDS = 200_000, 0.002, 5
ODDS, SURE, RIDGE = 2.0, 4.0, 0.2
#: The letters that a sign can stand for.
READINGS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "*": "aeiou", "_": "", "-": "", ".": ""}
#: Costs in nats: a sign read as a letter; a gap dropped, a readable sign dropped, or a sign left as it
#: is; a repeated letter dropped or kept.
READ, SKIP, LOSE, LEAVE, SQUEEZE, KEEP = 1.0, 0.7, 9.0, 12.0, 0.2, 1.5
SIZES = (4, 5, 6)
MASK, LONG = 4, 96

SIGNS = {ord(s): " " for s in READINGS}  # as they come back when they are left
IS_WHITE = np.array([chr(c).isspace() for c in range(0x3001)] + [False])
TAIL = re.compile(r"(?<!\*)\*{2,4}[!.,;:?)\"']*$")
CLOSERS = [ord(c) for c in "!.,;:?)\"'"]


def letter_class(code: np.ndarray) -> np.ndarray:
    """0 for what is no letter, 1 to 26 for a to z, 27 to 63 for the others."""
    out = np.where((code >= 97) & (code <= 122), code - 96, 0)
    return np.where(code >= 192, 27 + code % 37, out).astype(np.int64)


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer((" " + "  ".join(texts) + " ").encode("utf-32-le"), np.uint32).astype(np.int64)


def letter_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """trigram, n: letter trigrams within words over all documents, summed by each task first."""

    def run(batches):
        from tesserae.llm.common import _slices

        counts = np.zeros(1 << 18, np.int64)
        for b in batches:
            for x, y in _slices(b.column(0), 1 << 20):
                c = letter_class(_codes([(t or "").lower() for t in b.column(0).slice(x, y - x).to_pylist()]))
                inside = (c[1:-1] > 0) | (c[:-2] > 0)
                counts += np.bincount((c[:-2] << 12 | c[1:-1] << 6 | c[2:])[inside], minlength=1 << 18)
        hit = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(hit, pa.int32()), pa.array(counts[hit])], ["trigram", "n"])

    return docs.select(F.col(text_col).cast("string")).mapInArrow(returning(run), "trigram int, n long").groupBy("trigram").agg(F.sum("n").alias("n"))


def letter_model(counts: DataFrame) -> np.ndarray:
    """Log probability of a letter after two others, 64 x 64 x 64; the table has at most 2^18 rows."""
    table = np.zeros(1 << 18)
    for r in counts.collect():
        table[r["trigram"]] = r["n"]
    table = table.reshape(64, 64, 64)
    pair = table.sum(0)  # backing off to pairs of letters
    pair = (pair + 0.05) / (pair.sum(1, keepdims=True) + 0.05 * 64)
    seen = table.sum(2, keepdims=True)
    return np.log((table + 5 * pair[None]) / (seen + 5)).astype(np.float32)


class Arcs:
    """The ways to read a character, by its kind: class of the letter (-1: none comes), sign that comes
    (0: none, -1: the character itself) and cost. Kinds are numbered; `start` and `many` find a kind's ways."""

    PLAIN, STRETCHED, GAP, MASKED, CLOSING, SIGN = 0, 1, 2, 3, 4, 5

    def __init__(self):
        left = (0, 32, LEAVE)
        read = {s: [(ord(r) - 96, ord(r), READ) for r in readings] for s, readings in READINGS.items()}
        kinds = [
            [(-2, -1, 0.0)],
            [(-2, -1, KEEP), (-1, 0, SQUEEZE)],
            [(-1, 0, SKIP), (0, 32, 0.0)],
            [(c, 96 + c, READ) for c in range(1, 27)] + [(-1, 0, LOSE), left],
            [*read["!"], (-1, 0, LOSE), (0, 32, 0.0)],
        ]
        kinds += [[*read[s], (-1, 0, LOSE if read[s] else SKIP), left] for s in READINGS]
        kinds += [[*read[s], (-1, 0, KEEP), left] for s in READINGS]  # a sign after its like
        self.many = np.array([len(k) for k in kinds])
        self.start = np.cumsum(self.many) - self.many
        flat = [x for k in kinds for x in k]
        self.cls, self.out, self.cost = np.array([x[0] for x in flat]), np.array([x[1] for x in flat]), np.array([x[2] for x in flat])
        self.sign = np.full(0x3002, -1)
        self.sign[[ord(s) for s in READINGS]] = np.arange(len(READINGS))
        self.readable = np.array([bool(r) for r in READINGS.values()])

    def kinds(self, code: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The kind of every character of stretches that stand end to end."""
        n = len(code)
        owner = np.repeat(np.arange(len(size)), size)
        same = np.zeros(n + 1, bool)  # as the one before
        same[1:n] = (code[1:] == code[:-1]) & (owner[1:] == owner[:-1])
        after, before = same[1:], same[:-1]
        third = np.zeros(n, bool)
        third[1:] = before[1:] & before[:-1]
        small = np.minimum(code, 0x3001)
        sign = self.sign[small]
        kind = np.where(before & (third | after), self.STRETCHED, self.PLAIN)
        kind[IS_WHITE[small]] = self.GAP
        is_sign = sign >= 0
        star = code == 42
        kind[is_sign] = self.SIGN + sign[is_sign]
        again = is_sign & before & ~star & self.readable[np.maximum(sign, 0)]
        kind[again] += len(READINGS)
        edge = np.flatnonzero(~before)
        run = np.diff(np.append(edge, n))
        run = np.repeat(run, run)
        kind[star & (run >= 2) & (run <= MASK)] = self.MASKED
        last = np.maximum.reduceat(np.where(np.isin(code, CLOSERS), -1, np.arange(n)), begin)  # the last that closes nothing
        kind[(code == 33) & (np.arange(n) > last[owner])] = self.CLOSING
        return kind


class Channel:
    """Restores disguised stretches under a letter model."""

    def __init__(self, model: np.ndarray):
        self.model, self.known, self.tails, self.table = model, {}, {}, Arcs()

    def ways(self, own: np.ndarray, state: np.ndarray, score: np.ndarray, kind: np.ndarray, code: np.ndarray):
        """Every way on from each state at a character: state before, sign, stretch, new state, score. Of the ways
        to one letter of a masked run only the best for each last letter are listed."""
        model, arcs = self.model.reshape(-1), self.table
        masked = np.flatnonzero(kind == arcs.MASKED)
        rest = np.flatnonzero(kind != arcs.MASKED)
        many = arcs.many[kind[rest]]
        source = np.repeat(rest, many)
        arc = np.arange(len(source)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(arcs.start[kind[rest]], many)
        if len(masked):  # dropped or left; its letters follow below
            source = np.concatenate((source, masked, masked))
            arc = np.concatenate((arc, np.full(len(masked), arcs.start[arcs.MASKED] + 26), np.full(len(masked), arcs.start[arcs.MASKED] + 27)))
        cls, out, here = arcs.cls[arc], arcs.out[arc], code[source]
        cls, out = np.where(cls == -2, letter_class(here), cls), np.where(out == -1, here, out)
        old, letter = state[source], cls >= 0
        free = ~letter | ((cls == 0) & ((old & 63) == 0))
        worth = score[source] - arcs.cost[arc] + np.where(free, 0.0, model[old << 6 | np.maximum(cls, 0)])
        new = np.where(letter, (old << 6 | np.maximum(cls, 0)) & 4095, old)
        if len(masked):
            group = own[masked] << 6 | state[masked] & 63
            order = masked[np.argsort(group, kind="stable")]
            group = own[order] << 6 | state[order] & 63
            cut = np.flatnonzero(np.concatenate(([True], np.diff(group) != 0)))
            each = score[order][:, None] + self.model.reshape(4096, 64)[state[order], 1:27] - READ
            best = np.maximum.reduceat(each, cut, axis=0)
            which = np.where(each == np.repeat(best, np.diff(np.append(cut, len(order))), axis=0), np.arange(len(order))[:, None], -1)
            which = order[np.maximum.reduceat(which, cut, axis=0).ravel()]
            letters = np.tile(np.arange(1, 27), len(cut))
            source, out = np.concatenate((source, which)), np.concatenate((out, 96 + letters))
            worth, new = np.concatenate((worth, best.ravel())), np.concatenate((new, (state[which] & 63) << 6 | letters))
        return source, out, own[source], new, worth

    def tail(self, text: str) -> tuple[np.ndarray, list[str]]:
        """For every state, the worth and the reading of the best way through a tail to the end."""
        if text not in self.tails:
            arcs, state = self.table, np.arange(4096)
            code = np.array([ord(c) for c in text])
            kind = arcs.kinds(code, np.zeros(1, np.int64), np.array([len(code)]))
            worth, ways = self.ending(state), []
            for k, c in zip(kind[::-1].tolist(), code[::-1].tolist()):
                best, pick = np.full(4096, -np.inf), np.zeros((2, 4096), np.int64)
                for j in range(arcs.start[k], arcs.start[k] + arcs.many[k]):
                    cls, out = int(arcs.cls[j]), int(arcs.out[j])
                    cls, out = int(letter_class(np.array([c]))[0]) if cls == -2 else cls, c if out == -1 else out
                    to = state if cls < 0 else (state << 6 | cls) & 4095
                    step = 0.0 if cls < 0 else self.model.reshape(-1)[state << 6 | cls]
                    total = worth[to] - arcs.cost[j] + (np.where(state & 63, step, 0.0) if cls == 0 else step)
                    better = total > best
                    best[better], pick[0, better], pick[1, better] = total[better], to[better], out
                worth = best
                ways.append(pick)
            reading, at = np.zeros((4096, len(code)), np.uint32), state
            for i, pick in enumerate(reversed(ways)):
                reading[:, i], at = pick[1, at], pick[0, at]
            self.tails[text] = worth, [r[r > 0].tobytes().decode("utf-32-le") for r in reading]
        return self.tails[text]

    def ending(self, state: np.ndarray) -> np.ndarray:
        """The worth of an end after each state."""
        return np.where(state & 63, self.model.reshape(-1)[state << 6], 0.0)

    def search(self, stretches: list[str], first: list[int] | None = None) -> list[str]:
        """The likeliest reading of each stretch: all of them take a Viterbi step at a time. A state is the
        last two letter classes; of the ways into one, the best stays. Stars at the end, which many stretches
        have alike, are searched once from all states. `first` are the states before the stretches."""
        cut = [m.start() if (m := TAIL.search(s)) and m.start() else len(s) for s in stretches]
        order = sorted(range(len(stretches)), key=lambda k: -cut[k])
        size, stop = np.array([len(stretches[k]) for k in order]), np.array([cut[k] for k in order])
        begin = np.cumsum(size) - size
        code = np.frombuffer("".join(stretches[k] for k in order).encode("utf-32-le"), np.uint32).astype(np.int64)
        kind = self.table.kinds(code, begin, size)
        ends = [stretches[k][cut[k] :] for k in order]
        distinct = sorted({t for t in ends if t})
        tails = [self.ending(np.arange(4096)), *(self.tail(t)[0] for t in distinct)]
        number = {t: i + 1 for i, t in enumerate(distinct)} | {"": 0}
        which, tails = np.array([number[t] for t in ends]), np.stack(tails)
        n, longest = len(order), int(stop[0])
        own, state, score = np.arange(n), np.array(first, np.int64)[order] if first else np.zeros(n, np.int64), np.zeros(n)
        steps, final, closing = [], np.zeros(n, np.int64), np.zeros(n, np.int64)
        for i in range(longest):
            at = begin[own] + i
            source, out, owner, new, worth = self.ways(own, state, score, kind[at], code[at])
            group = owner << 12 | new
            best = np.lexsort((-worth, group))
            best = best[np.concatenate(([True], np.diff(group[best]) != 0))]
            own, state, score = owner[best], new[best], worth[best]
            steps.append((source[best], out[best]))
            live = int(np.searchsorted(-stop, -(i + 1)))  # stretches that go on
            if live < n and own[-1] >= live:
                done = np.flatnonzero(own >= live)
                pick = done[np.lexsort((-(score[done] + tails[which[own[done]], state[done]]), own[done]))]
                pick = pick[np.concatenate(([True], np.diff(own[pick]) != 0))]
                final[own[pick]], closing[own[pick]] = pick, state[pick]
                own, state, score = own[: done[0]], state[: done[0]], score[: done[0]]
        signs = np.zeros((n, longest), np.uint32)
        for i in range(longest - 1, -1, -1):
            live = int(np.searchsorted(-stop, -i))
            source, out = steps[i]
            signs[:live, i], final[:live] = out[final[:live]], source[final[:live]]
        restored = [""] * n
        for k, row, t, last in zip(order, signs, ends, closing.tolist()):
            restored[k] = row[row > 0].tobytes().decode("utf-32-le") + (self.tail(t)[1][last] if t else "")
        return restored

    def alone(self, stretch: str, first: int) -> str:
        """The reading of one stretch of any length. Every LONG characters, what lies before the last state that all
        paths have passed is settled and forgotten."""
        code = np.frombuffer(stretch.encode("utf-32-le"), np.uint32).astype(np.int64)
        kind = self.table.kinds(code, np.zeros(1, np.int64), np.array([len(code)]))
        state, score, steps, settled = np.array([first]), np.zeros(1), [], []

        def back(upto: int, at: int) -> None:
            signs = []
            for source, out in reversed(steps[:upto]):
                signs.append(int(out[at]))
                at = int(source[at])  # of the first step that is left, a place in what is settled
            settled.append("".join(chr(s) for s in reversed(signs) if s))

        for i in range(len(code)):
            source, out, _, new, worth = self.ways(np.zeros(len(state), np.int64), state, score, np.full(len(state), kind[i]), np.full(len(state), code[i]))
            best = np.lexsort((-worth, new))
            best = best[np.concatenate(([True], np.diff(new[best]) != 0))]
            state, score = new[best], worth[best] - worth[best].max()
            steps.append((source[best], out[best]))
            if len(steps) >= 2 * LONG and len(steps) % LONG == 0:
                at, k = np.arange(len(state)), len(steps)
                while k and len(at) > 1:
                    k -= 1
                    at = np.unique(steps[k][0][at])
                if k:
                    back(k, int(at[0]))
                    steps = steps[k:]
        back(len(steps), int(np.argmax(score + self.ending(state))))
        return "".join(settled)

    def cuts(self, stretch: str) -> list[tuple[str, int]]:
        """A long stretch in pieces with the state before each. Cuts lie behind two characters that have one reading and before a
        different one, so that neither the path nor a character's kind depends on what lies beyond."""
        code = np.frombuffer(stretch.encode("utf-32-le"), np.uint32).astype(np.int64)
        plain = self.table.kinds(code, np.zeros(1, np.int64), np.array([len(code)])) == self.table.PLAIN
        free = np.flatnonzero(plain[:-2] & plain[1:-1] & (code[2:] != code[1:-1])) + 2
        cls, out, a, state = letter_class(code), [], 0, 0
        while len(code) - a > LONG:
            k = int(np.searchsorted(free, a + LONG // 2))
            if k == len(free):
                break
            b = int(free[k])
            out.append((stretch[a:b], state))
            a, state = b, int(cls[b - 2] << 6 | cls[b - 1])
        return [*out, (stretch[a:], state)]

    def readings(self, stretches: list[str]) -> dict[str, str]:
        """Readings of the distinct stretches."""
        if len(self.known) > 200_000:
            self.known = {}
        known = self.known
        fresh = [s for s in dict.fromkeys(stretches) if s not in known]
        parts = {s: self.cuts(s) if len(s) > LONG else [(s, 0)] for s in fresh}
        pieces = sorted({p for s in parts.values() for p in s}, key=lambda p: len(p[0]))
        found, x = {}, 0
        while pieces and len(pieces[-1][0]) > 4 * LONG:
            longest = pieces.pop()
            found[longest] = self.alone(*longest)
        while x < len(pieces):
            y = x + 1
            while y < len(pieces) and y - x < 4096:
                y += 1
            found.update(zip(pieces[x:y], self.search([p for p, _ in pieces[x:y]], [s for _, s in pieces[x:y]])))
            x = y
        for s in fresh:
            known[s] = "".join(found[p] for p in parts[s])
        return known

    def restored(self, texts: list[str]) -> list[str]:
        """Lower-cased texts with every disguised stretch read anew."""
        texts = [t.lower() for t in texts]
        code = _codes(texts)
        n = len(code)
        small = np.minimum(code, 0x3001)
        letter, white, which = letter_class(code) > 0, IS_WHITE[small], self.table.sign[small]
        sign = which >= 0
        readable = sign & self.table.readable[which]
        before, after, starts_word = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1], starts_word[1:] = letter[:-1], letter[1:], white[:-1]
        odd = sign & after & (before | (starts_word & readable & (code != 42)))
        odd[2:] |= letter[2:] & (code[2:] == code[1:-1]) & (code[1:-1] == code[:-2])
        gap = sign | white
        alone = np.zeros(n, bool)
        alone[1:-1] = letter[1:-1] & gap[:-2] & gap[2:]
        chain = np.zeros(n, np.int8)  # single letters in a row from here on, up to four
        for back in range(4):
            chain[: max(0, n - 2 * back)] += (chain[: max(0, n - 2 * back)] == back) & alone[2 * back :]
        odd |= chain == 4
        edge = np.flatnonzero(np.diff(np.concatenate(([True], white, [True])).astype(np.int8)))
        first, last = edge[::2], edge[1::2]  # tokens
        if not len(first):
            return texts
        token = np.cumsum(np.bincount(first, minlength=n)[:n]) - 1  # of a character that isn't white
        ink = ~white
        has = lambda mark: np.bincount(token[mark & ink], minlength=len(first)) > 0
        wanted, sure = has(odd) | (has(letter) & has(readable)), has(odd)
        joined = np.zeros(len(first) + 1, np.int64)  # tokens that a row of single letters ties to the next one
        rows = np.flatnonzero(chain >= 3)
        np.add.at(joined, token[rows], 1)
        np.add.at(joined, token[rows + 4], -1)
        joined = np.cumsum(joined)[:-1] > 0
        wanted[token[rows]] = True
        wanted[1:] |= joined[:-1]
        starts = wanted & ~np.concatenate(([False], joined[:-1]))
        ends = wanted & ~joined
        a, b = first[starts], last[ends]
        if not len(a):
            return texts
        total = np.concatenate(([0], np.cumsum(sure)))
        clear = total[np.flatnonzero(ends) + 1] > total[np.flatnonzero(starts)]
        begin = np.cumsum([1] + [len(t) + 2 for t in texts])[:-1]
        owner = np.searchsorted(begin, a, "right") - 1
        a, b = (a - begin[owner]).tolist(), (b - begin[owner]).tolist()
        owner, clear = owner.tolist(), clear.tolist()
        stretches = [texts[k][x:y] for k, x, y in zip(owner, a, b)]
        known = self.readings(stretches)
        parts: dict[int, tuple[list[str], int]] = {}
        for k, x, y, s, certain in zip(owner, a, b, stretches, clear):
            out, done = parts.setdefault(k, ([], 0))
            read = known[s]
            if not certain and read != s:
                read = s if read.split() == s.translate(SIGNS).split() else f"{s} {read}"
            out += [texts[k][done:x], read]
            parts[k] = (out, y)
        for k, (out, done) in parts.items():
            texts[k] = "".join([*out, texts[k][done:]])
        return texts


def features(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's words and word beginnings."""
    from tesserae.llm.shingles import ODD, mix

    code = _codes(texts)
    cls = (code >= 192) | ((code >= 97) & (code <= 122))
    edge = np.flatnonzero(cls[1:] != cls[:-1]) + 1
    begin, end = edge[::2], edge[1::2]
    bounds = np.cumsum([0] + [len(t) + 2 for t in texts])
    if not len(begin):
        return [np.empty(0, np.uint64) for _ in texts]
    size = end - begin
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    power = np.cumprod(np.full(int(size.max()), ODD, np.uint64))
    value = mix(code[np.repeat(begin, size) + at].astype(np.uint64)) * power[at]
    upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value)))
    first = np.cumsum(size) - size
    parts, owners = [mix(upto[first + size] - upto[first]) ^ np.uint64(1)], [begin]
    for k in SIZES:
        long = size > k
        parts.append(mix(upto[first[long] + k] - upto[first[long]]) ^ np.uint64(k))
        owners.append(begin[long])
    value, owner = np.concatenate(parts), np.searchsorted(bounds, np.concatenate(owners), "right") - 1
    order = np.argsort(owner, kind="stable")
    value = value[order]
    cut = np.searchsorted(owner[order], np.arange(len(texts) + 1))
    return [np.unique(value[a:b]) for a, b in zip(cut, cut[1:])]


def fold(id_col: str) -> Column:
    """crc32 of the identifier as text, modulo FOLDS; null counts as fold 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS, F.lit(0))


class Model:
    """keys: sorted hashes of the features; weights: what each adds to the log odds; bias: without any."""

    def __init__(self, letters, keys, weights, bias):
        self.letters, self.keys, self.weights, self.bias = letters, keys, weights, bias
        self._channel = None

    def __getstate__(self):
        return self.__dict__ | {"_channel": None}

    def forget(self) -> None:
        """The readings of a task go with it; a worker holds on to the model until its next task."""
        self._channel = None

    def evidence(self, texts: list[str | None]) -> np.ndarray:
        """Log odds of each text."""
        if self._channel is None:
            self._channel = Channel(self.letters)
        hits = _hits(self._channel, texts, self.keys)
        return np.array([self.weights[h].sum() for h in hits]) + self.bias

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(texts))
        return 1 / (1 + np.exp(-np.clip(self.evidence(texts), -30, 30)))


def _hits(channel: Channel, texts: list[str | None], keys: np.ndarray) -> list[np.ndarray]:
    """The places in keys of each restored text's features."""
    from tesserae.llm.winnow import among

    found = features(channel.restored([t or "" for t in texts]))
    return [np.searchsorted(keys, f[among(f, keys)]) for f in found]


def _toxic_features(rows: DataFrame, letters: np.ndarray) -> DataFrame:
    """feature, n: in how many texts each occurs, summed by each task first."""

    def run(batches):
        from tesserae.llm.common import _slices

        channel, parts, waiting = Channel(letters), [], 0

        def flush():
            value, n = np.unique(np.concatenate(parts), return_counts=True)
            return pa.record_batch([pa.array(value.view(np.int64)), pa.array(n.astype(np.int64))], ["feature", "n"])

        for b in batches:
            for x, y in _slices(b.column(0), 1 << 20):
                more = features(channel.restored([t or "" for t in b.column(0).slice(x, y - x).to_pylist()]))
                parts += more
                waiting += sum(map(len, more))
                if waiting > 4_000_000:
                    yield flush()
                    parts, waiting = [], 0
        if parts:
            yield flush()

    return rows.select("text").mapInArrow(returning(run), "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def _occurrences(rows: DataFrame, letters: np.ndarray, keys: np.ndarray) -> DataFrame:
    """toxic, hits: the places in keys of each text's features."""

    def run(batches):
        from tesserae.llm.common import _slices

        channel = Channel(letters)
        for b in batches:
            for x, y in _slices(b.column(1), 1 << 20):
                part = b.slice(x, y - x)
                hits = _hits(channel, part.column(1).to_pylist(), keys)
                yield pa.record_batch([part.column(0), pa.array([h.astype(np.int32) for h in hits], pa.list_(pa.int32()))], ["toxic", "hits"])

    return rows.select((F.col("toxic") == 1).cast("int").alias("toxic"), "text").mapInArrow(returning(run), "toxic int, hits array<int>")


def _patterns(held: DataFrame, good: np.ndarray) -> DataFrame:
    """toxic, hits, n: rows with the same features among the good ones are one."""
    place = np.where(good, np.cumsum(good) - 1, -1).astype(np.int32)

    def run(batches):
        for b in batches:
            size = np.diff(b.column("hits").offsets.to_numpy())
            flat = place[b.column("hits").flatten().to_numpy()]
            owner = np.repeat(np.arange(len(b)), size)[flat >= 0]
            ends = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(b))))).astype(np.int32)
            yield pa.record_batch([b.column("toxic"), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat[flat >= 0]))], ["toxic", "hits"])

    return held.mapInArrow(returning(run), "toxic int, hits array<int>").groupBy("toxic", "hits").agg(F.count(F.lit(1)).alias("n"))


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS) -> Model:
    letters = letter_model(letter_counts(small_batches(docs), text_col))
    known = labels.where((fold(id_col) != 0) & F.col("toxic").isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max("toxic").alias("toxic"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(train_rows)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(F.broadcast(known), "id").select("toxic", "text")
    nothing = Model(letters, np.empty(0, np.uint64), np.empty(0), 0.0)
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sum(n for k, n in sizes.items() if k != 1)
    if not n1 or not n0:
        return nothing
    toxic = _toxic_features(rows.where("toxic = 1"), letters).where(F.col("n") >= max(2, math.ceil(SUPPORT * n1))).select("feature").toPandas()
    keys = np.sort(toxic["feature"].to_numpy(np.int64).view(np.uint64))
    held, path = store(_occurrences(rows, letters, keys), "toxicity-hits")
    seen = held.select("toxic", F.explode("hits").alias("hit")).groupBy("toxic", "hit").agg(F.count(F.lit(1)).alias("n")).toPandas()
    counts = np.zeros((2, len(keys)))
    counts[seen["toxic"].to_numpy(int), seen["hit"].to_numpy(int)] = seen["n"].to_numpy(float)
    good = _telling(counts[1], counts[0], n1, n0)
    found = _patterns(held, good).toPandas() if good.any() else None
    drop(spark, path)
    if found is None:
        return nothing
    weights, bias = _logistic(found["hits"].tolist(), found["toxic"].to_numpy(float), found["n"].to_numpy(float), int(good.sum()))
    return Model(letters, keys[good], weights, bias)


def _telling(seen1: np.ndarray, seen0: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Features whose odds are e^ODDS times as high in toxic rows, and by SURE deviations apart."""
    p1, p0 = (seen1 + 0.5) / (n1 + 1), (seen0 + 0.5) / (n0 + 1)
    odds = np.log(p1 / (1 - p1)) - np.log(p0 / (1 - p0))
    pooled = (seen1 + seen0) / (n1 + n0)
    sure = (seen1 / n1 - seen0 / n0) / np.sqrt(np.maximum(pooled * (1 - pooled), 1e-12) * (1 / n1 + 1 / n0))
    return (odds > ODDS) & (sure > SURE)


def _logistic(hits: list, y: np.ndarray, n: np.ndarray, width: int) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression with ridge penalty: Newton steps, each solved by
    conjugate gradients. Rows weigh n."""
    row = np.repeat(np.arange(len(y)), [len(h) for h in hits])
    col = np.concatenate([np.asarray(h, np.int64) for h in hits])
    times = lambda v: np.bincount(row, v[col], minlength=len(y)) + v[-1]
    back = lambda u: np.append(np.bincount(col, u[row], minlength=width), u.sum())
    shrink = np.append(np.full(width, RIDGE), 1e-3)
    w = np.zeros(width + 1)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(times(w), -30, 30)))
        rest = back(n * (y - p)) - shrink * w
        curve = n * p * (1 - p) + 1e-9
        step, way, left = np.zeros_like(w), rest.copy(), rest @ rest
        for _ in range(80):
            if left < 1e-12:
                break
            bent = back(curve * times(way)) + shrink * way
            move = left / (way @ bent)
            step, rest = step + move * way, rest - move * bent
            way, left = rest + rest @ rest / left * way, rest @ rest
        w = w + step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-5:
            break
    return w[:-1], float(w[-1])


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score of each row."""

    def run(ids, texts):
        yield pa.record_batch([ids, pa.array(model.scores(texts), pa.float64())], ["id", "score"])

    return map_texts(docs, run, "id long, score double", id_col, text_col, 1 << 20)


def without_toxic(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of docs that score below the threshold, with the columns of docs."""
    model, place = fit(spark, docs, labels, text_col=text_col), docs.columns.index(text_col)

    def run(batches):
        from tesserae.llm.common import _slices

        for b in batches:
            text = b.column(place)
            for x, y in _slices(text, 1 << 20):
                yield b.slice(x, y - x).filter(pa.array(model.scores(text.slice(x, y - x).to_pylist()) < threshold))
        model.forget()

    return docs.mapInArrow(returning(run), docs.schema)
