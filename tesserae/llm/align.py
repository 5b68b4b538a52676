"""Cross-tokenizer alignment by an event sweep.

Both vocabularies encode a space and the text into tokens whose bytes add up to it. The end of a token is an event
at a byte offset. Events travel in rows of one side and one stretch of a document: the offset of the stretch and
its ids, from which the ends follow. Rows of both sides are united, repartitioned by document, sorted
within partitions by offset and streamed through a machine whose state is the group that is open, the
document's counters and its distinct links. Where both sides end, a group closes; between two neighbouring ends of any side
lies exactly one link, since exactly one token of each side covers that stretch. Documents of one stretch are
swept many at a time with array operations.

How many documents hold an id pair linked is counted per block of documents first, so that a frequent pair travels
once a block. The counts go back to the blocks as tables, ordered like the blocks' own numbering of
pairs, and documents look their links up by number.

Null and empty texts, and texts that a vocabulary can't write byte by byte, have no tokens: zeros and ''. Rows that
repeat an identifier or a whole row are documents of their own, and count each. Other columns aren't read. An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tesserae.llm.common import drop, map_texts, store

#: Tokens in an event row at most; tokens swept at once; distinct links of documents that make a block.
STRETCH, SWEPT, BLOCK = 1 << 16, 1 << 18, 1 << 20
EVENTS = "key long, id long, side int, at long, ids binary"
SWEPT_ROWS = "block long, id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, pair long, docs long"


def _deflated(a: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(a).tobytes(), codec="zstd", asbytes=True) if a.size else b""


def _inflated(data: bytes, size: int, kind: str) -> np.ndarray:
    """size: how many numbers there are."""
    return np.frombuffer(pa.decompress(data, decompressed_size=size * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind) if size else np.empty(0, kind)


def events(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key (of the row), id, side, at (byte offset), ids (count, then 16 bits each, packed) of every stretch. A document
    without tokens has one empty stretch on either side."""
    seen: dict[int, int] = {}

    def run(ids, texts):
        from tesserae.llm.align_codec import BAD, aligned_encoder, sizes

        task = TaskContext.get().partitionId()
        first = seen.get(task, 0)
        seen[task] = first + len(texts)
        spaced = [" " + t if t else "" for t in texts]
        made = []
        for side, path in (("a", a_path), ("b", b_path)):
            coder = aligned_encoder(path, side)
            flat, offset = coder.encode(spaced)
            made.append((flat, offset, sizes(coder.table)))
        bad = set()
        for flat, offset, _ in made:
            bad.update(np.unique(np.searchsorted(offset, np.flatnonzero(flat == BAD), "right") - 1).tolist())
        rows = []
        for side, (flat, offset, size) in enumerate(made):
            raw = flat.astype("<u2")
            for k in range(len(texts)):
                own = raw[offset[k] : offset[k + 1]] if k not in bad else raw[:0]
                at = 0
                for a in range(0, max(len(own), 1), STRETCH):
                    part = own[a : a + STRETCH]
                    rows.append((k, side, at, len(part).to_bytes(4, "little") + _deflated(part)))
                    at += int(size[part].sum())
        k, side, at, data = zip(*rows)
        row = np.array(k)
        yield pa.record_batch([pa.array((task << 33) + first + row), ids.take(pa.array(row)), pa.array(side, pa.int32()), pa.array(at, pa.int64()), pa.array(data, pa.binary())], ["key", "id", "side", "at", "ids"])

    return map_texts(docs, run, EVENTS, id_col, text_col, most=1 << 20)


class _Document:
    """A document's counters, what is open on either side, and its distinct links so far."""

    def __init__(self, id_):
        self.id, self.open, self.counts = id_, ([], []), np.zeros(4, np.int64)
        self.sha, self.started, self.pairs, self.times = hashlib.sha256(), False, np.empty(0, np.int64), np.empty(0, np.int64)

    def tokens(self) -> int:
        return sum(len(x) for s in self.open for x in s)

    def said(self, text: bytes) -> None:
        """Groups as text, each closed by ';': the last ';' is held back."""
        if text:
            if self.started:
                self.sha.update(b";")
            self.sha.update(text[:-1])
            self.started = True


class Sweep:
    """Streams event rows, ordered by key and offset, into document rows and pair counts by block."""

    def __init__(self, size_a: np.ndarray, size_b: np.ndarray, first_block: int):
        self.size, self.block = (size_a, size_b), first_block
        self.doc, self.key, self.todo, self.waiting = None, None, [], 0
        self.done: list[_Document] = []
        self.distinct = 0
        signs = [f"{i}{end}".encode() for size, ends in ((size_a, ",|"), (size_b, ",;")) for i in range(len(size)) for end in ends]
        self.sign, self.sign_size = np.array(signs, "S6"), np.array([len(s) for s in signs], np.int64)

    def feed(self, key: int, id_, side: int, data: bytes):
        if key != self.key:
            yield from self._close()
            self.key, self.doc = key, _Document(id_)
        n = int.from_bytes(data[:4], "little")
        self.doc.open[side].append(_inflated(data[4:], n, "<u2"))
        if self.doc.tokens() >= 4 * STRETCH:
            self._advance()

    def finish(self):
        yield from self._close()
        self._sweep()
        yield from self._flush()

    def _close(self):
        if self.doc is not None:
            a, b = (np.concatenate(s) if s else np.empty(0, np.uint16) for s in self.doc.open)
            self._add(self.doc, a, b, True)
            if self.waiting >= SWEPT:
                self._sweep()
            if self.distinct >= BLOCK:
                yield from self._flush()

    def _advance(self) -> None:
        """Of a long document, what lies before the last common end that is known goes on; the rest stays open."""
        a, b = (np.concatenate(s) if s else np.empty(0, np.uint16) for s in self.doc.open)
        ends = [np.cumsum(size[x]) for size, x in zip(self.size, (a, b))]
        common = np.intersect1d(*ends, assume_unique=True)
        if common.size:
            i, j = (int(np.searchsorted(e, common[-1])) + 1 for e in ends)
            self._add(self.doc, a[:i], b[:j], False)
            self.doc.open = ([a[i:]], [b[j:]])
            if self.waiting >= SWEPT:
                self._sweep()
        else:
            self.doc.open = ([a], [b])

    def _add(self, doc: _Document, a: np.ndarray, b: np.ndarray, last: bool) -> None:
        self.todo.append((doc, a, b, last))
        self.waiting += len(a) + len(b) + 1

    def _sweep(self) -> None:
        """All stretches in hand at once; each begins and ends where both sides do."""
        todo, self.todo, self.waiting = self.todo, [], 0
        if not todo:
            return
        a, b = (np.concatenate([t[k] for t in todo]).astype(np.int64) for k in (1, 2))
        of_a, of_b = (np.repeat(np.arange(len(todo)), [len(t[k]) for t in todo]) for k in (1, 2))
        end_a, end_b = np.cumsum(self.size[0][a]), np.cumsum(self.size[1][b])
        over_a = np.searchsorted(end_b, end_a)  # for each token of a, the token of b that covers its last byte
        over_b = np.searchsorted(end_a, end_b)
        shut_a, shut_b = (end_b[over_a] == end_a, end_a[over_b] == end_b) if a.size else (np.zeros(0, bool), np.zeros(0, bool))
        last_a, last_b = np.flatnonzero(shut_a), np.flatnonzero(shut_b)
        group_a, group_b = np.cumsum(shut_a) - shut_a, np.cumsum(shut_b) - shut_b
        order = np.empty(a.size + b.size, np.int64)
        order[np.arange(a.size) + np.concatenate(([0], last_b + 1))[group_a]] = 2 * a + shut_a
        order[np.arange(b.size) + np.append(last_a + 1, 0)[group_b]] = 2 * (len(self.size[0]) + b) + shut_b
        n = np.stack([np.bincount(x, minlength=len(todo)) for x in (of_a, of_b, of_a[shut_a])])
        written = self.sign[order].tobytes().translate(None, b"\0")
        at = np.concatenate(([0], np.cumsum(self.sign_size[order])))[np.concatenate(([0], np.cumsum(n[0] + n[1])))]
        alone = ~shut_b
        pair = np.concatenate((a << 16 | b[over_a], a[over_b[alone]] << 16 | b[alone]))
        linked, times = np.unique(np.concatenate((of_a, of_b[alone])) << 32 | pair, return_counts=True)
        cut = np.searchsorted(linked, np.arange(len(todo) + 1) << 32)
        linked &= 0xFFFFFFFF
        for k, (doc, _, _, last) in enumerate(todo):
            doc.counts += (n[0, k], n[1, k], n[2, k], n[0, k] + n[1, k] - n[2, k])
            doc.said(written[at[k] : at[k + 1]])
            pairs, count = linked[cut[k] : cut[k + 1]], times[cut[k] : cut[k + 1]]
            if doc.pairs.size:
                pairs, back = np.unique(np.concatenate((doc.pairs, pairs)), return_inverse=True)
                count = np.bincount(back, np.concatenate((doc.times, count)), len(pairs)).astype(np.int64)
            doc.pairs, doc.times = pairs, count
            if last:
                self.done.append(doc)
                self.distinct += len(pairs) + 1

    def _flush(self):
        """A block: its documents, whose links name the block's pairs by number, and a row for each pair."""
        done, self.done, self.distinct = self.done, [], 0
        if not done:
            return
        every, number, docs = np.unique(np.concatenate([d.pairs for d in done]), return_inverse=True, return_counts=True)
        at, rows = 0, []
        for d in done:
            own = number[at : at + len(d.pairs)]
            at += len(own)
            packed = len(own).to_bytes(4, "little") + _deflated(np.concatenate((np.diff(own, prepend=0).astype("<u4"), d.times.astype("<u4"))))
            rows.append((self.block, d.id, *d.counts.tolist(), d.sha.hexdigest() if d.started else "", packed))
        names = [f.split()[0] for f in SWEPT_ROWS.split(", ")]
        kinds = [pa.int64()] * 6 + [pa.string(), pa.binary(), pa.int64(), pa.int64()]
        for a in range(0, len(rows), 2000):
            part = list(zip(*rows[a : a + 2000]))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(part, kinds)] + [pa.nulls(len(part[0]), pa.int64())] * 2, names)
        for a in range(0, len(every), 50_000):
            part = every[a : a + 50_000]
            yield pa.record_batch([pa.array(np.full(len(part), self.block)), *(pa.nulls(len(part), t) for t in kinds[1:8]), pa.array(part), pa.array(docs[a : a + 50_000])], names)
        self.block += 1


def swept(events_: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """SWEPT_ROWS: document rows (pair null) and pair rows (pair = 65536 * A id + B id, docs of the block that hold it)."""

    def run(batches):
        from tesserae.llm.align_codec import aligned_encoder, sizes

        sweep = Sweep(*(sizes(aligned_encoder(p, s).table) for p, s in ((a_path, "a"), (b_path, "b"))), TaskContext.get().partitionId() << 32)
        for b in batches:
            for key, id_, side, data in zip(*(b.column(c).to_pylist() for c in ("key", "id", "side", "ids"))):
                yield from sweep.feed(key, id_, side, data)
        yield from sweep.finish()

    return events_.repartition("key").sortWithinPartitions("key", "at", "side").mapInArrow(run, SWEPT_ROWS)


def pair_counts(made: DataFrame) -> DataFrame:
    """pair, count (documents that hold it linked), best (whether it is the highest of its A id)."""
    counts = made.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("docs").alias("count"))
    of_a = Window.partitionBy(F.shiftright("pair", 16))
    return counts.withColumn("best", F.col("count") == F.max("count").over(of_a))


def looked_up(made: DataFrame, counts: DataFrame) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    facts = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    known = made.where("pair IS NOT NULL").select("block", "pair").join(counts, "pair").select("block", "pair", "count", "best")
    both = known.unionByName(made.where("pair IS NULL").select("block", *facts, "links"), allowMissingColumns=True)
    ordered = both.repartition("block").sortWithinPartitions("block", F.col("pair").asc_nulls_last()).select("block", "pair", "count", "best", *facts, "links")

    def run(batches):
        block, table, parts = None, None, []
        for b in batches:
            blocks, is_pair = b.column("block").to_numpy(), b.column("pair").is_valid().to_numpy(zero_copy_only=False)
            edges = np.concatenate(([0], np.flatnonzero((np.diff(blocks) != 0) | (np.diff(is_pair.astype(np.int8)) != 0)) + 1, [len(b)]))
            for x, y in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if y == x:
                    continue
                if blocks[x] != block:
                    block, table, parts = blocks[x], None, []
                part = b.slice(x, y - x)
                if is_pair[x]:
                    parts.append(np.stack((part.column("count").to_numpy(), part.column("best").to_numpy(zero_copy_only=False).astype(np.int64))))
                    continue
                if table is None:
                    table = np.concatenate(parts, axis=1) if parts else np.zeros((2, 0), np.int64)
                sums = np.zeros((2, len(part)), np.int64)
                for k, data in enumerate(part.column("links").to_pylist()):
                    n = int.from_bytes(data[:4], "little")
                    raw = _inflated(data[4:], 2 * n, "<u4").astype(np.int64)
                    sums[:, k] = table[:, np.cumsum(raw[:n])] @ raw[n:]
                cols = {c: part.column(c) for c in facts}
                yield pa.record_batch([*(cols[c] for c in facts[:5]), pa.array(sums[1]), pa.array(sums[0]), cols["groups_sha256"]], [*facts[:5], "n_best", "count_sum", "groups_sha256"])

    return ordered.mapInArrow(run, "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def aligned(spark: SparkSession, docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two tables: a row per document (see looked_up), and the map of ids between the vocabularies: a_id, b_id,
    count, best of every pair that is linked anywhere."""
    made, _ = store(swept(events(docs, a_path, b_path, id_col, text_col), a_path, b_path), "swept")
    counts, _ = store(pair_counts(made), "pairs")
    return looked_up(made, counts), counts.select(F.shiftright("pair", 16).alias("a_id"), F.col("pair").bitwiseAND(0xFFFF).alias("b_id"), "count", "best")
