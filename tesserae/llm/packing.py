"""Sequence packing by minimum bin slack on the histogram of remaining lengths.

A document of n tokens gives n div width full windows and one remainder. Remainders have fewer than
`width` distinct lengths, so the driver plans on their histogram, whose size doesn't grow with the
corpus: with the longest remaining length fixed, a subset-sum over a bitset (lengths with counts, split
in powers of two) finds the multiset that fills the window closest to capacity, and backtracking gives
its counts. The pattern is repeated as often as the counts allow, so each one uses up a length and
there are at most `width` patterns.

Which piece takes which place follows by arithmetic from its rank among the pieces of its length. Ranks
come from counts per task and length, written down as the pieces are made; no group is gathered.

Null text counts as empty; such a document is its end id alone. Repeated rows are packed each. Columns other than
identifier and text aren't read. Empty tables give no pieces. Cuts fall only at multiples of `width` within a document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tesserae.llm.common import drop, map_texts, returning, store


def pieces(docs: DataFrame, vocabulary: str, end_id: int = 0, width: int = 1024, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per piece: id, start, length, ids_crc32, doc_tokens, task and rank (among the task's pieces
    of that length), and ids if asked for."""
    seen: dict[int, np.ndarray] = {}

    def run(ids, texts):
        from tesserae.llm.tokens import crc32, encoder

        flat, offset = encoder(vocabulary).encode(texts)
        flat = np.insert(flat, offset[1:], np.uint32(end_id))
        size = np.diff(offset) + 1
        begin = np.cumsum(size) - size
        n = -(-size // width)
        row = np.repeat(np.arange(len(size)), n)
        start = (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)) * width
        length = np.minimum(width, size[row] - start)
        at = begin[row] + start
        raw = flat.astype("<u4")
        crc = [crc32(raw[a : a + k]) for a, k in zip(at.tolist(), length.tolist())]
        task = TaskContext.get().partitionId()
        counts = seen.setdefault(task, np.zeros(width + 1, np.int64))
        order = np.argsort(length, kind="stable")
        run_start = np.searchsorted(length[order], length[order])
        rank = np.empty(len(row), np.int64)
        rank[order] = np.arange(len(row)) - run_start + counts[length[order]]
        counts += np.bincount(length, minlength=width + 1)
        cols = [ids.take(pa.array(row)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(size[row]), pa.array(np.full(len(row), task, np.int64)), pa.array(rank)]
        names = ["id", "start", "length", "ids_crc32", "doc_tokens", "task", "rank"]
        if with_ids:
            cols.append(pa.ListArray.from_arrays(pa.array(np.append(at, flat.size), pa.int32()), pa.array(flat.astype(np.int32))))
            names.append("ids")
        yield pa.record_batch(cols, names)

    schema = "id long, start long, length long, ids_crc32 long, doc_tokens long, task long, rank long" + ", ids array<int>" * with_ids
    return map_texts(docs, run, schema, id_col, text_col)


def fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths, within their counts, whose sum is closest to room from below."""
    reach, layers = 1, []
    for length in sorted(counts, reverse=True):
        left, k = min(counts[length], room // length), 1
        while left:
            take = min(k, left)
            layers.append((reach, length, take))
            reach |= reach << take * length & (1 << room + 1) - 1
            left, k = left - take, 2 * k
        if reach >> room & 1:
            break
    target, out = reach.bit_length() - 1, {}
    for before, length, take in reversed(layers):
        if not before >> target & 1:
            out[length] = out.get(length, 0) + take
            target -= take * length
    return out


def plan(histogram: dict[int, int], width: int) -> np.ndarray:
    """Rows (length, first rank, first sequence, copies in a sequence, offset), by length and rank."""
    left = {k: n for k, n in histogram.items() if n}
    used, sequence, rows = dict.fromkeys(left, 0), 0, []
    while left:
        longest = max(left)
        rest = {**left, longest: left[longest] - 1}
        pattern = fill({k: n for k, n in rest.items() if n}, width - longest)
        pattern[longest] = pattern.get(longest, 0) + 1
        times, offset = min(left[k] // m for k, m in pattern.items()), 0
        for length in sorted(pattern, reverse=True):
            m = pattern[length]
            rows.append((length, used[length], sequence, m, offset))
            offset += m * length
            used[length] += m * times
            left[length] -= m * times
            if not left[length]:
                del left[length]
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def place(made: DataFrame, width: int) -> DataFrame:
    """made (stored pieces) with sequence_id and offset."""
    per_task = made.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most width rows
    table = plan(histogram, width)
    # full windows, most of the ids, stay where they are: their bases are one row a task; only remainders travel
    full = made.where(F.col("length") == width).join(F.broadcast(base.where(F.col("length") == width).select("task", "base")), "task")
    rest = made.where(F.col("length") < width).join(base.where(F.col("length") < width), ["length", "task"])
    ranked = full.unionByName(rest).withColumn("rank", F.col("rank") + F.col("base")).drop("base", "task")
    schema = T.StructType([*ranked.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches):
        bound = int(table[:, 1].max(initial=0)) + 1
        for b in batches:
            length, rank = (b.column(c).to_numpy() for c in ("length", "rank"))
            k = np.searchsorted(table[:, 0] * bound + table[:, 1], length * bound + np.minimum(rank, bound - 1), "right") - 1
            j = rank - table[k, 1]
            yield pa.record_batch([*b.columns, pa.array(table[k, 2] + j // table[k, 3]), pa.array(table[k, 4] + j % table[k, 3] * length)], [*b.schema.names, "sequence_id", "offset"])

    return ranked.mapInArrow(returning(run), schema).drop("rank")


def packed(spark: SparkSession, docs: DataFrame, vocabulary: str, end_id: int = 0, width: int = 1024, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, start, length, ids_crc32, doc_tokens[, ids], sequence_id, offset of each piece."""
    made, _ = store(pieces(docs, vocabulary, end_id, width, with_ids, id_col, text_col), "pieces")
    return place(made, width)
