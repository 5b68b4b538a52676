"""Source divergence audit: how far the sources of a language stand apart, and by which terms.

Every (lang, source) group is a vector of term counts over the terms that its language keeps. Terms are dealt
to blocks by a digest, so a block of a language holds a bounded number of counts, and each group has a compressed
vector in every block. Vectors meet as in a round-robin tournament: in round r of the circle method each
group of a language has one partner, one of the two stays where it is and the other's vector travels to it;
after all rounds every pair has met once in every block. A task keeps the resident vector of a group and block
and reads the peers that circulate to it one by one in the order of rounds; a meeting gives the pair's value in both directions.
Values of the blocks are added up. While a block's vectors are made, a heap for each group keeps its best terms
of that block; ranking merges the heaps.

All arithmetic is exact, in integers: floor(SCALE * a / b) is made by long division, which holds up to 9 * 10^15
occurrences in a language.

Null text, lang or source count as ''. Terms are maximal runs of ASCII letters and characters beyond ASCII, with
only A-Z lower-cased. A group without terms still meets all others; a language that keeps no term has value
0 for all its pairs. Rows that repeat an identifier or a whole row count each; identifiers and other columns aren't read.
Equal values are ranked by item, in the order of UTF-8. An empty table has no groups.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tesserae.llm.common import drop, store

SCALE, SMOOTH = 1_000_000_000, 2
#: Counts that a task of the first scan holds before it passes them on; counts of a block of terms, about.
HELD, BLOCK = 300_000, 1 << 14
#: Every byte that can't be part of a term becomes a blank, capital letters become small ones.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """lang, source, term (UTF-8), n, df: occurrences and documents, pre-added within tasks. Every group has a row
    of counts 0 for the term ''."""

    def run(batches):
        held: dict[tuple[bytes, bytes], tuple[Counter, Counter]] = {}
        size = 0

        def flush():
            rows = [(lang, source, w, k, df[w]) for (lang, source), (n, df) in held.items() for w, k in n.items()]
            cols = list(zip(*rows)) or [()] * 5
            names = ["lang", "source", "term", "n", "df"]
            for a in range(0, len(rows), 50_000):
                yield pa.record_batch([pa.array(c[a : a + 50_000], t) for c, t in zip(cols, [pa.binary()] * 3 + [pa.int64()] * 2)], names)

        for b in batches:
            for lang, source, text in zip(*(b.column(k) for k in range(3))):
                key = (lang.as_py(), source.as_py())
                if key not in held:
                    held[key] = (Counter({b"": 0}), Counter())
                n, df = held[key]
                size -= len(n)
                own = Counter((text.as_py() or b"").translate(_TABLE).split())
                n.update(own)
                df.update(own.keys())
                size += len(n)
                if size > HELD:
                    yield from flush()
                    held, size = {}, 0
        yield from flush()

    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary").alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))]
    found = docs.select(*named).mapInArrow(run, "lang binary, source binary, term binary, n long, df long")
    return found.select(*(F.col(c).cast("string").alias(c) for c in ("lang", "source", "term")), "n", "df")


def kept_counts(partial: DataFrame, least_docs: int = 10) -> DataFrame:
    """lang, source, term, n, lang_n of the kept terms; rows of the term '' stay, as marks of the groups."""
    summed = partial.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    w = Window.partitionBy("lang", "term")
    return summed.withColumns({"lang_n": F.sum("n").over(w), "lang_df": F.sum("df").over(w)}).where((F.col("lang_df") >= least_docs) | (F.col("term") == "")).select("lang", "source", "term", "n", "lang_n")


def groups(kept: DataFrame) -> DataFrame:
    """lang, source, g (number within the language), total, and of the language: terms, lang_total, sources, blocks."""
    real = F.col("term") != ""
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count_if(real).alias("counts"))
    terms = kept.groupBy("lang", "term").agg(F.lit(1).alias("one")).groupBy("lang").agg(F.count_if(real).alias("terms"))
    w = Window.partitionBy("lang")
    numbered = own.select("lang", "source", "total", (F.row_number().over(w.orderBy("source")) - 1).alias("g"), F.sum("total").over(w).alias("lang_total"), F.count(F.lit(1)).over(w).alias("sources"), F.floor(F.sum("counts").over(w) / (BLOCK + 4 * F.count(F.lit(1)).over(w))).alias("full"))
    return numbered.join(terms, "lang").withColumn("blocks", (F.col("full") + 1).cast("int")).drop("full")


def share(count: np.ndarray | int, total: int, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * terms)), exact: three digits of the quotient at a time."""
    rest, below = np.asarray(count, np.int64) + SMOOTH, np.int64(total + SMOOTH * terms)
    out = np.zeros_like(rest)
    for _ in range(3):
        q, rest = np.divmod(rest * 1000, below)
        out = out * 1000 + q
    return out + 1


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


def _packed(index: np.ndarray, n: np.ndarray) -> bytes:
    return zlib.compress(np.diff(index, prepend=0).astype("<u4").tobytes() + n.astype("<i8").tobytes(), 1)


def _dense(data: bytes, width: int) -> np.ndarray:
    raw = zlib.decompress(data)
    k, out = len(raw) // 12, np.zeros(width, np.int64)
    out[np.cumsum(np.frombuffer(raw, "<u4", k).astype(np.int64))] = np.frombuffer(raw, "<i8", k, 4 * k)
    return out


def _best(value: np.ndarray, term: list[bytes], most: int) -> list[int]:
    """Places of the greatest values, ties by term: a heap of bounded size."""
    import heapq

    return heapq.nsmallest(most, range(len(term)), key=lambda i: (-value[i], term[i]))


def vectors(kept: DataFrame, group: DataFrame, most: int = 10) -> DataFrame:
    """A row per language, block and group: width (terms of the block) and data, the group's compressed vector. And
    rows with data null: term and value, the best of a group's terms in the block."""
    facts = ["g", "total", "terms", "lang_total"]
    marks = group.select("lang", *facts, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit("").alias("term"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("lang_n"))
    named = kept.where("term <> ''").join(group, ["lang", "source"])
    block = F.pmod(F.xxhash64("term"), F.col("blocks").cast("long")).cast("int")
    entries = named.select("lang", *facts, block.alias("block"), "term", "n", "lang_n").unionByName(marks.select("lang", *facts, F.col("block").cast("int"), "term", "n", "lang_n"))

    def make(t: pa.Table) -> pa.Table:
        lang, block_ = t["lang"][0].as_py(), t["block"][0].as_py()
        term = t["term"].combine_chunks().cast(pa.binary())
        code = pc.rank(term, sort_keys="ascending", tiebreaker="dense").to_numpy().astype(np.int64) - 2  # '' is always there, and first
        g, n, lang_n, total = (t[c].to_numpy() for c in ("g", "n", "lang_n", "total"))
        terms, lang_total, width = t["terms"][0].as_py(), t["lang_total"][0].as_py(), int(code.max()) + 1
        order = np.lexsort((code, g))
        ends = np.append(np.flatnonzero(np.diff(g[order])) + 1, len(g))
        rows, a = [], 0
        for b in ends.tolist():
            at = order[a:b][1:]  # the mark comes first
            mine, whole = int(g[order[a]]), int(total[order[a]])
            rows.append((lang, block_, mine, whole, terms, width, _packed(code[at], n[at]), None, None))
            p, q = share(n[at], whole, terms), share(lang_n[at], lang_total, terms)
            at, value = at[p > q], apart(p, q)[p > q]
            cut = np.argpartition(value, len(value) - most)[len(value) - most] if len(value) > most else None
            if cut is not None:  # what can't be among the best needn't be compared by term
                at, value = at[value >= value[cut]], value[value >= value[cut]]
            names = term.take(pa.array(at)).to_pylist()
            rows += [(lang, block_, mine, whole, terms, width, None, names[i].decode(), int(value[i])) for i in _best(value, names, most)]
            a = b
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=pa.schema(fields))

    kinds = {"lang": pa.string(), "block": pa.int32(), "g": pa.int32(), "total": pa.int64(), "terms": pa.int64(), "width": pa.int32(), "data": pa.binary(), "term": pa.string(), "value": pa.int64()}
    fields = [pa.field(k, v) for k, v in kinds.items()]
    return entries.groupBy("lang", "block").applyInArrow(make, "lang string, block int, g int, total long, terms long, width int, data binary, term string, value long")


def partner(g, r, even):
    """Whom group g of an even number meets in round r of the circle method: the last stays, the others turn."""
    turned = F.pmod(r - g, even - 1)
    return F.when(g == even - 1, F.pmod(r * (even / 2).cast("int"), even - 1)).otherwise(F.when(turned == g, even - 1).otherwise(turned))


def meetings(made: DataFrame, group: DataFrame) -> DataFrame:
    """lang, g, other, value of all pairs of a language, both directions, a row per block."""
    sizes = group.select("lang", F.col("sources").cast("int").alias("sources")).distinct()
    vec = made.where("data IS NOT NULL").join(sizes, "lang").select("lang", "block", "g", "total", "terms", "width", "data", "sources")
    even = (F.col("sources") + F.col("sources") % 2).cast("int")
    played = F.transform(F.sequence(F.lit(0), F.greatest(even - 2, F.lit(0))), lambda r: F.struct(r.alias("round"), partner(F.col("g"), r, even).cast("int").alias("home")))
    # of two that meet, the lesser travels if their sum is odd, the greater if it is even: half of the games each
    travels = F.filter(played, lambda x: (x["home"] < F.col("sources")) & (x["home"] != F.col("g")) & (((x["home"] + F.col("g")) % 2 == 1) == (F.col("g") < x["home"])))
    peers = vec.select("*", F.explode(travels).alias("x")).select("lang", "block", F.col("x.home").alias("home"), F.col("x.round").alias("round"), "g", "total", "terms", "width", "data")
    stay = vec.select("lang", "block", F.col("g").alias("home"), F.lit(-1).alias("round"), "g", "total", "terms", "width", "data")
    ordered = stay.unionByName(peers).repartition("lang", "block", "home").sortWithinPartitions("lang", "block", "home", "round")

    def run(batches):
        own = None  # the resident vector's shares: replaced whenever a round of -1 comes
        for b in batches:
            lang, _, home, turn, g, total, terms, width, data = (b.column(k).to_pylist() for k in range(9))
            out = []
            for i in range(len(g)):
                p = share(_dense(data[i], width[i]), total[i], terms[i])
                if turn[i] < 0:
                    own = p
                    continue
                there, back = int(apart(own, p).sum()), int(apart(p, own).sum())
                out += [(lang[i], home[i], g[i], there), (lang[i], g[i], home[i], back)]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 4, [pa.string(), pa.int32(), pa.int32(), pa.int64()])], ["lang", "g", "other", "value"])

    return ordered.mapInArrow(run, "lang string, g int, other int, value long")


def audit(spark: SparkSession, docs: DataFrame, least_docs: int = 10, most: int = 10, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank: for each group the other sources of its language,
    the farthest first, and its `most` most telling terms."""
    kept, kept_path = store(kept_counts(term_counts(docs, lang_col, source_col, text_col), least_docs), "kept")
    group, _ = store(groups(kept), "groups")
    made, _ = store(vectors(kept, group, most), "vectors")
    drop(spark, kept_path)
    names = group.select("lang", "g", "source")
    pair = meetings(made, group).groupBy("lang", "g", "other").agg(F.sum("value").alias("value")).join(names.select("lang", F.col("g").alias("other"), F.col("source").alias("item")), ["lang", "other"])
    both = pair.select("lang", "g", F.lit("pair").alias("part"), "item", "value").unionByName(made.where("data IS NULL").select("lang", "g", F.lit("term").alias("part"), F.col("term").alias("item"), "value"))
    ranked = both.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "g", "part").orderBy(F.col("value").desc(), "item")))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= most)).join(names, ["lang", "g"]).select("lang", "source", "part", "item", "value", "rank")
