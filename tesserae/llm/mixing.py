"""Mixing sources to target weights by weighted fair queueing, with DataFrame operations only.

Each source gets a target: its weight's part of `share` times all words, but never more than `repeats` times
its own size; what a stopped source leaves goes to the others by weight. Its documents stand in a shuffled order
(by a digest of identifier and text, so reruns agree) and queue again for each repeat. A document's virtual
finish time is the number of the source's words up to its end, divided by the source's target. Documents of all
sources are range-sorted by finish time and served until the budget is used up. That can't be before time 1,
when a source that is never behind has its target; so documents that end later stand at the edge and queue as
packets of QUANTUM words, which keeps each source within a packet or so of its target however long its
documents are. The packet at the edge is cut. Served words are a prefix of each source's queue, which gives
every document its part.

Numbers within a source come from sums over slices of the digest and over blocks of slices, so no task holds a
whole source; positions
in the global order come from sums over the files of the sorted table. A row for each source and a row for each
file are the only tables that pass one task.

Words are maximal runs without white space. A null text counts as empty; rows without words take part in
nothing and come out with taken 0. A null source is a source of its own, the last in order. Rows that repeat an
identifier or a whole row are documents of their own; equal rows may change places. Other columns aren't read.
An empty table gives an empty mix, one without words targets of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tesserae.llm.common import SPACE, drop, store, text_or_empty

#: Words of a packet at the edge; bits of the digest that number a source's slices.
QUANTUM, SLICE_BITS = 32, 14
WEIGHTS = (5, 2, 1)

_BEFORE = (Window.unboundedPreceding, -1)


def words(text: Column) -> Column:
    """Number of words, without an array of them."""
    return F.length(F.translate(F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "w"), SPACE, "")).cast("long")


def sized(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """key (the source, sortable, null last), id, size, slice, tick (place in the shuffled order) of each row."""
    text, source = text_or_empty(text_col), F.col(source_col).cast("string")
    tick = F.md5(F.concat_ws("/", F.col(id_col).cast("long").cast("string"), F.md5(text)))
    rows = docs.select(F.when(source.isNull(), "t").otherwise(F.concat(F.lit("s"), source)).alias("key"), F.col(id_col).cast("long").alias("id"), words(text).alias("size"), tick.alias("tick"))
    return rows.select("key", "id", "size", F.shiftright(F.conv(F.substring("tick", 1, 4), 16, 10).cast("int"), 16 - SLICE_BITS).alias("slice"), F.unhex("tick").alias("tick"))


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, repeats: int = 2) -> DataFrame:
    """key, source_size, target, horizon of each source, from key, source_size. Sources are stopped in the order of
    their cap a unit of weight, which ends where resharing the excess again and again does. By `horizon`
    (a finish time) the budget is used up for certain; null where that can't be said beforehand."""
    by_key, all_rows = Window.orderBy("key"), Window.partitionBy()
    kinds = F.array(*(F.lit(float(w)) for w in weights))
    ranked = totals.withColumn("weight", F.element_at(kinds, (F.row_number().over(by_key) - 1) % len(weights) + 1)).withColumn("cap", F.lit(float(repeats)) * F.col("source_size"))
    ranked = ranked.withColumns({"ratio": F.col("cap") / F.col("weight"), "budget": F.lit(float(share)) * F.sum("source_size").over(all_rows), "weights": F.sum("weight").over(all_rows)})
    stops = Window.orderBy("ratio", "key").rowsBetween(*_BEFORE)
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(stops), F.lit(0.0))) / (F.col("weights") - F.coalesce(F.sum("weight").over(stops), F.lit(0.0)))
    open_ = ranked.withColumn("open", level <= F.col("ratio"))
    of = lambda c, stopped: F.coalesce(F.sum(F.when(F.col("open") != stopped, F.col(c))).over(all_rows), F.lit(0.0))
    shared = open_.withColumns({"left": F.col("budget") - of("cap", True), "among": of("weight", False)})
    aimed = shared.withColumn("target", F.when(F.col("open"), F.try_divide(F.col("weight") * F.col("left"), "among")).otherwise(F.col("cap")))
    late = F.lit(1.0) + F.try_divide(F.lit(float(QUANTUM)) * F.count_if("open").over(all_rows), "left")
    first_end = F.min(F.when(F.col("open"), F.try_divide("cap", "target"))).over(all_rows)
    return aimed.select("key", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"), F.when(late <= first_end, late * (1 + 1e-9)).alias("horizon"))


def placed(rows: DataFrame, sums: DataFrame) -> DataFrame:
    """key, id, size, start (words of the source's shuffled order before the row)."""
    block = sums.withColumn("block", F.shiftright("slice", SLICE_BITS // 2))
    sum_before = lambda by, order: F.coalesce(F.sum("n").over(Window.partitionBy(*by).orderBy(order).rowsBetween(*_BEFORE)), F.lit(0))
    blocks = block.groupBy("key", "block").agg(F.sum("n").alias("n")).select("key", "block", sum_before(["key"], "block").alias("far"))
    before = block.withColumn("near", sum_before(["key", "block"], "slice")).join(blocks, ["key", "block"]).select("key", "slice", (F.col("far") + F.col("near")).alias("before"))
    within = F.coalesce(F.sum("size").over(Window.partitionBy("key", "slice").orderBy("tick", "id").rowsBetween(*_BEFORE)), F.lit(0))
    filled = rows.where("size > 0").withColumn("within", within).join(before, ["key", "slice"])
    return filled.select("key", "id", "size", (F.col("before") + F.col("within")).alias("start")).unionByName(rows.where("size = 0").select("key", "id", "size", F.lit(0).cast("long").alias("start")))


def queue(place: DataFrame, aims: DataFrame, repeats: int = 2, quantum: int = QUANTUM) -> DataFrame:
    """key, id, turn, words, ends (the source's words up to there), finish, of every document or packet up to the
    horizon, in the order of service."""
    met = place.where("size > 0").join(aims.where("target > 0"), "key")
    turns = met.select("*", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("turn"))
    first = F.col("turn") * F.col("source_size") + F.col("start")
    soon = F.coalesce(first / F.col("target") <= F.col("horizon"), F.lit(True))
    step = F.when((first + F.col("size")) / F.col("target") <= 1, F.col("size")).otherwise(F.lit(quantum)).cast("long")
    cut = turns.where(soon).withColumn("step", step).select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("size") - 1) / F.col("step")))).alias("packet"))
    length = F.least(F.col("step"), F.col("size") - F.col("packet") * F.col("step"))
    made = cut.select("key", "id", "turn", length.alias("words"), (first + F.col("packet") * F.col("step") + length).alias("ends"), "target", "horizon")
    timed = made.withColumn("finish", F.col("ends").cast("double") / F.col("target")).where(F.coalesce(F.col("finish") <= F.col("horizon"), F.lit(True)))
    return timed.select("key", "id", "turn", "words", "ends", "finish").orderBy("finish", "key", "ends")


def served(sorted_queue: DataFrame, budget: Column) -> DataFrame:
    """The stored queue with `position` (words served before the packet) and `taken`; packets beyond the budget go.
    The files of the stored table are the ranges of the sort."""
    named = sorted_queue.select("*", F.col("_metadata.file_path").alias("file"))
    files = named.groupBy("file").agg(F.sum("words").alias("n"), F.min(F.struct("finish", "key", "ends")).alias("first"))
    files = files.select("file", F.coalesce(F.sum("n").over(Window.orderBy("first").rowsBetween(*_BEFORE)), F.lit(0)).alias("before"))
    within = F.coalesce(F.sum("words").over(Window.partitionBy("file").orderBy("finish", "key", "ends").rowsBetween(*_BEFORE)), F.lit(0))
    at = named.withColumn("within", within).join(files, "file").withColumn("position", F.col("before") + F.col("within")).drop("within", "before", "file")
    return at.withColumn("taken", F.least(F.col("words"), budget - F.col("position"))).where("taken > 0")


def mixed(spark: SparkSession, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, repeats: int = 2, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two tables. Per row of docs: id, source, size, source_size, target, taken (words the mix takes, repeats
    counted). And the mix itself: key, id, turn, words, ends, finish, position, taken of every document or packet
    served; ordered by position it is the training order."""
    rows, rows_path = store(sized(docs, id_col, source_col, text_col), "sized")
    sums, sums_path = store(rows.groupBy("key", "slice").agg(F.sum("size").alias("n")), "slices")
    aims, aims_path = store(targets(sums.groupBy("key").agg(F.sum("n").alias("source_size")), weights, share, repeats), "targets")
    place, _ = store(placed(rows, sums), "placed")
    total = aims.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("t")).first()[0]
    line, _ = store(queue(place, aims, repeats), "queue")
    mix = served(line, F.lit(int(total * share)))
    got, _ = store(aims.join(mix.groupBy("key").agg(F.sum("taken").alias("got")), "key", "left"), "served")
    drop(spark, rows_path, sums_path, aims_path)
    part = lambda turn: F.greatest(F.lit(0), F.least(F.col("size"), F.coalesce("got", F.lit(0)) - F.lit(turn) * F.col("source_size") - F.col("start")))
    taken = sum((part(k) for k in range(1, repeats)), part(0))
    source = F.when(F.col("key") != "t", F.substring("key", 2, 1 << 30)).alias("source")
    return place.join(got, "key").select("id", source, "size", "source_size", "target", taken.cast("long").alias("taken")), mix
