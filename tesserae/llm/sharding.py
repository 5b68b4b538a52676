"""Shards along a Hilbert curve.

Several metadata columns are quantised (categories by their place in a dictionary, spread over the axis by
their counts, or by a hash of their value where more than DICTIONARY values occur; numbers by quantiles of
the table) and interleaved into a curve index. Sorted by it, neighbouring rows agree in all dimensions,
so runs cut from the order have narrow ranges in each and files can be skipped on any of them.

Only slim rows are sorted: a range exchange on (curve, identifier, checksum), in which a hot cell is
split by identifier. Each task numbers its own rows; the tasks' totals, one row each, make the numbers
global. Two laws: `rows` cuts runs whose counts differ by one at most, `bytes` runs of near equal size.

The order is by curve cell, then identifier, so that equal texts of one cell may part where a run is cut.
Only the named columns are read, under names of the operator's own.

Null text has size 1 (as empty text has); null metadata is a category of its own. Repeated rows keep a
place each. Equal texts have equal lengths and, where their other metadata agree, one curve cell.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tesserae.llm.common import store, text_or_empty

BITS, DICTIONARY = 8, 4096


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Curve index of each row of unsigned coordinates (rows x dimensions, `bits` bits each), by
    exchanging and reflecting axes bit by bit and then Gray coding."""
    x = cells.astype(np.uint64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        bit = np.uint64(1 << level)
        low = bit - np.uint64(1)
        for d in range(dims):
            hit = (x[d] & bit) != 0
            swap = np.where(hit, np.uint64(0), (x[0] ^ x[d]) & low)
            x[0] ^= np.where(hit, low, swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & np.uint64(1 << level), np.uint64((1 << level) - 1), np.uint64(0))
    x ^= turn
    out = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            out = out << np.uint64(1) | x[d] >> np.uint64(level) & np.uint64(1)
    return out.astype(np.int64)


def curve(df: DataFrame, categories: list[Column], numbers: list[Column], bits: int = BITS) -> Column:
    """Curve index as a column. Quantile bounds (2^bits at most for each number) are found on df."""
    cuts = []
    if numbers:
        share = [i / (1 << bits) for i in range(1, 1 << bits)]
        got = df.agg(*(F.percentile_approx(n, share, 10_000).alias(f"q{i}") for i, n in enumerate(numbers))).first()
        cuts = [np.unique(np.array(q or [], float)) for q in got]
    n_cat = len(categories)
    named = [F.coalesce(c.cast("string"), F.lit("\0null")) for c in categories]
    places = [_dictionary(df, c, bits) for c in named]

    @F.pandas_udf("long")
    def index(cols: pd.DataFrame) -> pd.Series:
        def cell(i: int) -> np.ndarray:
            column = cols.iloc[:, i]
            if i >= n_cat:
                return np.searchsorted(cuts[i - n_cat], column.fillna(-1).to_numpy(float), "right")
            return column.to_numpy(np.int64) if places[i] is None else column.map(places[i]).to_numpy(np.int64)

        return pd.Series(hilbert(np.stack([cell(i) for i in range(cols.shape[1])], 1), bits))

    cells = [c if p is not None else F.pmod(F.xxhash64(c), F.lit(1 << bits)) for c, p in zip(named, places)]
    return index(F.struct(*(c.alias(f"c{i}") for i, c in enumerate([*cells, *numbers]))))


def _dictionary(df: DataFrame, value: Column, bits: int) -> dict[str, int] | None:
    """The cell of each value: the middle of its share of all rows, in the order of the values. None where there
    are more than DICTIONARY values."""
    counts = df.groupBy(value.alias("v")).agg(F.count(F.lit(1)).alias("n")).limit(DICTIONARY + 1).collect()
    if len(counts) > DICTIONARY:
        return None
    counts = sorted((r["v"], r["n"]) for r in counts)
    upto = np.cumsum([0, *(n for _, n in counts)])
    return {v: int((upto[k] + upto[k + 1]) * (1 << bits) // (2 * max(1, upto[-1]))) for k, (v, _) in enumerate(counts)}


def shards_met(placed: DataFrame, docs: DataFrame, column: str, id_col: str = "doc_id") -> DataFrame:
    """value, shards: how many shards hold rows of each value of a column, which is what a scan for it opens."""
    met = docs.select(F.col(id_col).alias("__id"), F.col(column).alias("value")).join(placed.select(F.col("id").alias("__id"), "shard"), "__id")
    return met.groupBy("value").agg(F.count_distinct("shard").alias("shards"))


def ranked(df: DataFrame, order: list[str], weight: str) -> tuple[DataFrame, int, int]:
    """df (slim) in total order with rank and before (sum of earlier weights), the number of rows and
    the total weight."""
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order)

    def number(batches):
        task, n, w = TaskContext.get().partitionId(), 0, 0
        for b in batches:
            weights = b.column(weight).to_numpy()
            upto = np.cumsum(weights)
            yield pa.record_batch([*b.columns, pa.array(np.full(len(b), task, np.int64)), pa.array(np.arange(n, n + len(b))), pa.array(w + upto - weights)], [*b.schema.names, "task", "rank", "before"])
            n, w = n + len(b), w + int(upto[-1]) if len(b) else w

    schema = T.StructType([*df.schema.fields, *(T.StructField(c, T.LongType()) for c in ("task", "rank", "before"))])
    held, _ = store(sorted_.mapInArrow(number, schema), "ranked")
    sums = held.groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.sum(weight).alias("w"))
    upto = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("task", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("n0"), F.coalesce(F.sum("w").over(upto), F.lit(0)).alias("w0"))  # a row a task
    total = held.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(weight), F.lit(0)).alias("w")).first()
    out = held.join(F.broadcast(base), "task").withColumn("rank", F.col("rank") + F.col("n0")).withColumn("before", F.col("before") + F.col("w0"))
    return out.drop("task", "n0", "w0"), total["n"], total["w"]


def shards(spark: SparkSession, docs: DataFrame, n_shards: int = 16, law: str = "rows", categories: tuple[str, ...] = ("source", "lang"), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, text_crc32, law, curve, shard, slot of each row."""
    if law not in ("rows", "bytes"):
        raise ValueError(f"unknown law {law!r}")
    body = F.encode(text_or_empty(text_col), "utf-8")
    slim = docs.select(F.col(id_col).cast("long").alias("id"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), *(F.col(f"`{c}`").alias(f"m{i}") for i, c in enumerate(categories) if c in docs.columns))
    held, _ = store(slim, "slim")
    named = [F.col(c) for c in held.columns if c[0] == "m"]
    keyed = held.select("id", "size", "text_crc32", curve(held, named, [F.col("size").cast("double")]).alias("curve"))
    rows, n, total = ranked(keyed, ["curve", "id", "text_crc32"], "size")
    if law == "rows":
        shard = F.expr(f"(rank * {n_shards} + {n_shards - 1}) div {max(n, 1)}")
        return rows.withColumn("shard", shard).select("id", "size", "text_crc32", F.lit(law).alias("law"), "curve", F.col("shard").cast("int").alias("shard"), (F.col("rank") - F.expr(f"shard * {n} div {n_shards}")).alias("slot"))
    cut = rows.withColumn("shard", F.expr(f"cast(((before * 2 + size) * {n_shards}) div (2 * {max(total, 1)}) as int)"))
    first = cut.groupBy("shard").agg(F.min("rank").alias("first"))
    return cut.join(F.broadcast(first), "shard").select("id", "size", "text_crc32", F.lit(law).alias("law"), "curve", "shard", (F.col("rank") - F.col("first")).alias("slot"))


def write(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """The rows of docs as Parquet, a folder for each shard, in curve order within it."""
    at = placed.select(F.col("id").alias("__id"), "shard", "slot")
    docs.join(at, docs[id_col] == at["__id"]).drop("__id").repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
