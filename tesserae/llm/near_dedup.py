"""Near-duplicate groups by MinHash and an LSH forest.

1. Documents with the same set of shingles form a class. A class is a node of the graph, whatever identifiers its
   rows have; its row with the smallest identifier and text hash stands for it.
2. Forest: every class enters each of TREES orders with that tree's DEPTH signature values as its key.
   Orders are range-partitioned and sorted. Neighbours within WINDOW rows whose keys share a prefix of
   MIN_DEPTH values are candidates. Depth adapts by region: where more than WINDOW rows share a prefix,
   sorting has already put those with a longer common prefix side by side, so the prefix that makes a
   candidate is as long as the region is dense. Candidates whose whole signatures agree in fewer than
   `loose` places are put aside; each task passes on a spanning forest of the rest.
3. Components of the candidates are clusters. All sets of a cluster meet in one task and every pair
   that isn't yet connected is decided on the full sets. A cluster of more than SMALL_ROWS members or
   SMALL_SHINGLES shingles isn't gathered: its sets go through the sorted orders again, with exact
   decisions inside a window. That is only a cheap first pass: where it leaves a cluster in several
   parts, a prefix filter drops the members that can have no partner in another part, and all pairs of
   the rest that lie in two parts are decided exactly, block by block.
4. Components of the links, labelled by smallest identifier.

Nothing is capped: a group of any size is spread over the ranges of each order. Null, empty and blank
texts have no shingles and are linked with nothing. Rows that repeat an identifier with other texts are linked as
their texts are, each on its own, and so are rows without an identifier, whose label is null where none of their group has
one. Repeated rows are one document. Other columns aren't read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm.common import drop, map_texts, returning, store
from tesserae.operators.components import connected_components

TREES, DEPTH, MIN_DEPTH, WINDOW = 12, 8, 2, 12
SMALL_ROWS, SMALL_SHINGLES = 256, 4_000_000
BLOCK, COUNT_BITS, SHARED_BITS = 1024, 18, 20
#: Node numbers of classes that have no identifier of their own begin here; the label of rows without one.
SPARE, NONE = 1 << 62, 2**63 - 1


def text_hash(text_col: str = "text"):
    """Where a row's text is found again, beside its identifier; `sketches` makes the same number."""
    return F.coalesce(F.xxhash64(F.col(text_col).cast("string")), F.lit(0))


def label(id_col: str = "doc_id"):
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NONE))


def sketches(docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """id, at (hash of the text), n_shingles, digest of the set, signature (TREES * DEPTH little-endian 32-bit values)."""

    def run(ids, texts):
        import hashlib

        import xxhash

        from tesserae.llm.shingles import shingle_sets, signatures

        raw = [(t or "").encode() for t in texts]
        at = np.array([xxhash.xxh64_intdigest(t, 42) for t in raw], np.uint64).view(np.int64)
        sets = shingle_sets(raw, k)
        sig = signatures(sets, TREES * DEPTH).astype("<u4")
        yield pa.record_batch(
            [ids, pa.array(at), pa.array([len(s) for s in sets], pa.int64()), pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]), pa.array([r.tobytes() for r in sig])],
            ["id", "at", "n_shingles", "digest", "signature"])

    return map_texts(docs, run, "id long, at long, n_shingles long, digest binary, signature binary", id_col, text_col, 2 << 20)


def _order_rows(classes: DataFrame, extra: list[str]) -> DataFrame:
    """A row for each tree: tree, key (big-endian, so that bytes sort as numbers), then id, signature."""

    def run(batches):
        for b in batches:
            n = len(b)
            sig = np.frombuffer(b"".join(b.column("signature").to_pylist()), "<u4").reshape(n, TREES, DEPTH)
            keys = sig.transpose(1, 0, 2).astype(">u4")
            rest = [c for c in ("id", "signature", *extra)]
            for t in range(TREES):
                key = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * DEPTH), n, [None, pa.py_buffer(keys[t].tobytes())]).cast(pa.binary())
                low = pa.FixedSizeBinaryArray.from_buffers(pa.binary(TREES * DEPTH), n, [None, pa.py_buffer(sig.reshape(n, -1).astype(np.uint8).tobytes())]).cast(pa.binary())
                yield pa.record_batch([pa.array(np.full(n, t, np.int32)), key, *(low if c == "signature" else b.column(c) for c in rest)], ["tree", "key", *rest])

    types = {"id": "long", "signature": "binary", "set": "binary", "cluster": "long"}
    wide = classes.select("id", "signature", *extra).mapInArrow(returning(run), "tree int, key binary, " + ", ".join(f"{c} {types[c]}" for c in ["id", "signature", *extra]))
    order = ["cluster"] * ("cluster" in extra) + ["tree", "key", "id"]
    return wide.repartitionByRange(*order).sortWithinPartitions(*order)


class _Union:
    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        root = x
        while (p := up.setdefault(root, root)) != root:
            root = p
        while up[x] != root:
            up[x], x = root, up[x]
        return root

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def candidates(classes: DataFrame, percent: int) -> DataFrame:
    """src, dst: a spanning forest, for each task, of the neighbours that may be similar."""
    loose = _loose(percent)

    def run(batches):
        union, pairs = _Union(), []
        tail = None  # the last WINDOW rows: trees, keys, signatures, ids
        for b in batches:
            n = len(b)
            now = [b.column("tree").to_numpy(), np.frombuffer(b"".join(b.column("key").to_pylist()), ">u4").reshape(n, DEPTH), np.frombuffer(b"".join(b.column("signature").to_pylist()), np.uint8).reshape(n, -1), b.column("id").to_numpy()]
            tree, key, sig, ids = [np.concatenate((t, x)) for t, x in zip(tail, now)] if tail else now
            old = len(ids) - n
            for w in range(1, min(WINDOW, len(ids) - 1) + 1):
                lo = max(old, w)
                i = np.arange(lo, len(ids))
                i = i[(tree[i] == tree[i - w]) & (key[i, :MIN_DEPTH] == key[i - w, :MIN_DEPTH]).all(1)]
                i = i[(sig[i] == sig[i - w]).sum(1) >= loose]
                pairs += [(a, c) for a, c in zip(ids[i].tolist(), ids[i - w].tolist()) if union.join(a, c)]
            tail = [x[-WINDOW:] for x in (tree, key, sig, ids)]
            if len(union.up) > 1_000_000:  # forgetting only repeats edges
                union = _Union()
            if pairs:
                yield pa.record_batch([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["src", "dst"])
                pairs = []

    return _order_rows(classes, []).mapInArrow(returning(run), "src long, dst long")


def _loose(percent: int) -> int:
    """Agreeing places below which a pair of that similarity is five deviations away."""
    n, p = TREES * DEPTH, percent / 100
    return int(n * p - 5 * (n * p * (1 - p)) ** 0.5)


def _decide(ids, sets, percent, union, sig=None):
    """Edges of a spanning forest of all pairs (of a bounded cluster) that are similar."""
    from tesserae.llm.shingles import jaccard_at_least

    size = np.array([len(s) for s in sets])
    order = np.argsort(size, kind="stable")
    for x, i in enumerate(order):
        y = x - 1
        while y >= 0 and 100 * size[order[y]] >= percent * size[i]:
            j = order[y]
            if union.find(ids[i]) != union.find(ids[j]) and jaccard_at_least(sets[j], sets[i], percent):
                union.join(ids[i], ids[j])
                yield ids[i], ids[j]
            y -= 1


def _edges(pairs) -> pa.RecordBatch:
    return pa.record_batch([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["src", "dst"])


def _small_links(members: DataFrame, percent: int) -> DataFrame:
    """members: cluster, id, set."""

    def run(batches):
        cluster, ids, sets = None, [], []
        for b in batches:
            out = []
            for c, i, s in zip(b.column("cluster").to_pylist(), b.column("id").to_pylist(), b.column("set")):
                if c != cluster:
                    out += _decide(ids, sets, percent, _Union())
                    cluster, ids, sets = c, [], []
                ids.append(i)
                sets.append(np.frombuffer(s.as_buffer(), np.uint64).copy())
            if out:
                yield _edges(out)
        if out := [*_decide(ids, sets, percent, _Union())]:
            yield _edges(out)

    return members.select("cluster", "id", "set").repartition("cluster").sortWithinPartitions("cluster").mapInArrow(returning(run), "src long, dst long")


def _large_links(members: DataFrame, percent: int) -> DataFrame:
    """members: cluster, id, set, signature. Exact decisions within the windows of every order."""
    loose = _loose(percent)

    def run(batches):
        from collections import deque

        from tesserae.llm.shingles import jaccard_at_least

        union, recent, at = _Union(), deque(maxlen=4 * WINDOW), None
        for b in batches:
            out = []
            for c, t, i, g, s in zip(*(b.column(x) for x in ("cluster", "tree", "id", "signature", "set"))):
                here, i = (c.as_py(), t.as_py()), i.as_py()
                sig, own = np.frombuffer(g.as_buffer(), np.uint8), np.frombuffer(s.as_buffer(), np.uint64).copy()
                if here[0] != (at or here)[0]:
                    union = _Union()
                if here != at:
                    recent.clear()
                    at = here
                if recent:
                    near = np.flatnonzero((np.stack([r[1] for r in recent]) == sig).sum(1) >= loose)
                    for k in near.tolist():
                        j, _, other = recent[k]
                        if union.find(i) != union.find(j) and jaccard_at_least(own, other, percent):
                            union.join(i, j)
                            out.append((i, j))
                recent.append((i, sig.copy(), own))
            if out:
                yield _edges(out)

    return _order_rows(members, ["cluster", "set"]).mapInArrow(returning(run), "src long, dst long")


def _bucket(cluster: int, shingles: np.ndarray, bits: int) -> np.ndarray:
    from tesserae.llm.shingles import ODD, mix

    seed = mix(np.array([cluster], np.int64).view(np.uint64) * ODD + np.uint64(1))
    return (mix(shingles ^ seed) >> np.uint64(64 - bits)).astype(np.int64)


def _open_members(members: DataFrame, links: DataFrame) -> DataFrame:
    """cluster, id, set, comp of the clusters that the links so far leave in several parts."""
    made: list[str] = []
    reached, _ = store(connected_components(links, made=made), "parts")
    drop(links.sparkSession, *made)
    parts = members.select("cluster", "id").join(reached.withColumnRenamed("node", "id"), "id", "left").select("cluster", "id", F.coalesce("component", "id").alias("comp"))
    several = parts.groupBy("cluster").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a < b").select("cluster")
    return members.select("cluster", "id", "set").join(parts.join(several, "cluster").select("id", "comp"), "id").select("cluster", "id", "set", "comp")


def _sharing(rows: DataFrame, percent: int) -> DataFrame:
    """The rows (cluster, id, set, comp) that can have a similar partner in another part, by prefix filter.
    Shingles are ordered from rare to frequent by counts of 2^COUNT_BITS hashes. A similar pair shares one
    among the shorter set's first n - ceil(2tn / (1 + t)) + 1 and the longer one's first n - ceil(tn) + 1.
    Hashes that meet only let more rows through."""
    spark = rows.sparkSession

    def count(batches):
        total = np.zeros(1 << COUNT_BITS, np.int64)
        for b in batches:
            for c, s in zip(b.column("cluster").to_pylist(), b.column("set")):
                np.add.at(total, _bucket(c, np.frombuffer(s.as_buffer(), np.uint64), COUNT_BITS), 1)
        hit = np.flatnonzero(total)
        yield pa.record_batch([pa.array(hit), pa.array(total[hit])], ["bucket", "n"])

    counted = rows.select("cluster", "set").mapInArrow(returning(count), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    often = np.zeros(1 << COUNT_BITS, np.int64)
    often[counted["bucket"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    sent = spark.sparkContext.broadcast(often)

    def prefix(c, s):
        n = len(s)
        first = s[np.lexsort((s, sent.value[_bucket(c, s, COUNT_BITS)]))[: n + 1 + -percent * n // 100]]
        return first, n + 1 + -2 * percent * n // (100 + percent)

    def run(batches):
        for b in batches:
            for c, p, s in zip(b.column("cluster").to_pylist(), b.column("comp").to_pylist(), b.column("set")):
                first, short = prefix(c, np.frombuffer(s.as_buffer(), np.uint64))
                n = len(first)
                yield pa.record_batch([pa.array(np.full(n, c)), pa.array(first.view(np.int64)), pa.array(np.full(n, p)), pa.array(np.arange(n) < short)], ["cluster", "shingle", "comp", "short"])

    tokens = rows.select("cluster", "comp", "set").mapInArrow(returning(run), "cluster long, shingle long, comp long, short boolean")
    shared = tokens.groupBy("cluster", "shingle").agg(F.min("comp").alias("a"), F.max("comp").alias("b"), F.max("short").alias("short")).where("a < b AND short")

    def buckets(batches):
        for b in batches:
            c, s = b.column("cluster").to_pylist(), b.column("shingle").to_numpy().view(np.uint64)
            yield pa.record_batch([pa.array([int(_bucket(x, s[i : i + 1], SHARED_BITS)[0]) for i, x in enumerate(c)], pa.int64())], ["bucket"])

    alive = np.zeros(1 << SHARED_BITS, bool)
    alive[shared.select("cluster", "shingle").mapInArrow(returning(buckets), "bucket long").distinct().toPandas()["bucket"].to_numpy(np.int64)] = True
    known = spark.sparkContext.broadcast(alive)

    def keep(batches):
        for b in batches:
            yield b.filter(pa.array([bool(known.value[_bucket(c, prefix(c, np.frombuffer(s.as_buffer(), np.uint64))[0], SHARED_BITS)].any()) for c, s in zip(b.column("cluster").to_pylist(), b.column("set"))], pa.bool_()))

    return rows.mapInArrow(returning(keep), "cluster long, id long, set binary, comp long")


def _similar(sets: list, others: list, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all similar pairs of two lists of sets. The shingles in many of the others meet in a
    matrix product, the rest through lists of places; both count exactly."""
    flat = np.concatenate(others)
    owner = np.repeat(np.arange(len(others)), [len(s) for s in others])
    order = np.argsort(flat, kind="stable")
    keys, start, many = np.unique(flat[order], return_index=True, return_counts=True)
    owner = owner[order]
    mine = np.concatenate(sets)
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    at = np.minimum(np.searchsorted(keys, mine), len(keys) - 1)
    hit = keys[at] == mine
    at, of = at[hit], of[hit]
    common = np.zeros((len(sets), len(others)), np.float32)
    dense = np.flatnonzero(many > 32)
    for x in range(0, len(dense), 1024):
        cols = dense[x : x + 1024]
        place = np.full(len(keys), -1)
        place[cols] = np.arange(len(cols))
        left, right = np.zeros((len(sets), len(cols)), np.float32), np.zeros((len(others), len(cols)), np.float32)
        inside = place[at] >= 0
        left[of[inside], place[at[inside]]] = 1
        of_key = np.repeat(place, many)
        right[owner[of_key >= 0], of_key[of_key >= 0]] = 1
        common += left @ right.T
    few = many[at] <= 32
    at, of = at[few], of[few]
    for i, (x, y) in enumerate(zip(np.searchsorted(of, np.arange(len(sets))), np.searchsorted(of, np.arange(len(sets)), "right"))):
        if y > x:
            n = many[at[x:y]]
            spots = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[at[x:y]], n)
            common[i] += np.bincount(owner[spots], minlength=len(others))
    na, nb = np.array([len(s) for s in sets]), np.array([len(s) for s in others])
    common = np.rint(common).astype(np.int64)
    return np.nonzero((100 * common >= percent * (na[:, None] + nb - common)) & (common > 0))


def _rest_links(rows: DataFrame, percent: int) -> DataFrame:
    """rows: cluster, id, set, comp. Every pair of a cluster that lies in two parts is decided. Parts of more
    than BLOCK rows have blocks of their own, the others share some; a task gets two blocks."""
    whole = rows.groupBy("cluster", "comp").agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.when(F.col("n") > BLOCK, F.col("comp")).otherwise(F.lit(-(2**63))))
    sizes = whole.groupBy("cluster", "part").agg(F.ceil(F.sum("n") / BLOCK).alias("blocks"))
    own = F.col("part") > -(2**63)
    placed = (
        rows.join(whole.where(own).select("cluster", "comp", "part"), ["cluster", "comp"], "left").withColumn("part", F.coalesce("part", F.lit(-(2**63))))
        .join(sizes, ["cluster", "part"])
        .withColumn("block", F.pmod(F.when(own, F.xxhash64("id")).otherwise(F.xxhash64("comp")), F.col("blocks"))).drop("blocks")
    )
    blocks = sizes.select("cluster", "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    other = blocks.toDF("cluster", "part2", "block2")
    pairs = blocks.join(other, "cluster").where("part < part2 OR (part = part2 AND block <= block2 AND part = -9223372036854775807 - 1)")
    a = pairs.select("cluster", "part", "block", F.struct("part", "block", "part2", "block2").alias("pair"), F.lit(0).alias("side"))
    b = pairs.where("part <> part2 OR block <> block2").select("cluster", F.col("part2").alias("part"), F.col("block2").alias("block"), F.struct("part", "block", "part2", "block2").alias("pair"), F.lit(1).alias("side"))
    dealt = placed.join(a.union(b), ["cluster", "part", "block"]).select("cluster", F.xxhash64("cluster", "pair").alias("task"), "side", "id", "comp", "set")

    def decide(group):
        left, right = ([r for r in group if r[0] == k] for k in (0, 1))
        alone = not right
        right = right or left
        if not left:
            return []
        union, out = _Union(), []
        for x in range(0, len(left), 512):
            part = left[x : x + 512]
            for y in range(x if alone else 0, len(right), 2048):
                with_ = right[y : y + 2048]
                for i, j in zip(*(v.tolist() for v in _similar([r[3] for r in part], [r[3] for r in with_], percent))):
                    if union.join(part[i][2], with_[j][2]):
                        out.append((part[i][1], with_[j][1]))
        return out

    def run(batches):
        now, group = None, []
        for b in batches:
            out = []
            for t, side, i, p, s in zip(*(b.column(x).to_pylist() for x in ("task", "side", "id", "comp")), b.column("set")):
                if t != now:
                    out += decide(group)
                    now, group = t, []
                group.append((side, i, p, np.frombuffer(s.as_buffer(), np.uint64).copy()))
            if out:
                yield _edges(out)
        if out := decide(group):
            yield _edges(out)

    return dealt.repartition("task").sortWithinPartitions("task").drop("cluster").mapInArrow(returning(run), "src long, dst long")


def _with_sets(docs: DataFrame, wanted: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """wanted (id, label, at, cluster, ...) with the full set of each: id, set, cluster, ... Repeated rows give one."""
    cols = [c for c in wanted.columns if c not in ("id", "label", "at")]
    rows = docs.select(label(id_col).alias("label"), text_hash(text_col).alias("at"), F.col(text_col).alias("text")).join(wanted.hint("merge"), ["label", "at"])  # they grow with the corpus
    texts = rows.groupBy("label", "at").agg(*(F.first(c).alias(c) for c in ("id", "text", *cols))).select("id", "text", *cols)
    schema = "id long, set binary, " + ", ".join(f"{c} {dict(wanted.dtypes)[c].replace('bigint', 'long')}" for c in cols)

    def run(batches):
        from tesserae.llm.common import _slices
        from tesserae.llm.shingles import shingle_sets

        for b in batches:
            for x, y in _slices(b.column("text"), 2 << 20):
                part = b.slice(x, y - x)
                sets = shingle_sets([(t or "").encode() for t in part.column("text").to_pylist()], k)
                yield pa.record_batch([part.column("id"), pa.array([s.tobytes() for s in sets], pa.binary()), *(part.column(c) for c in cols)], ["id", "set", *cols])

    return texts.mapInArrow(returning(run), schema)


def components(spark: SparkSession, docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, at (hash of the text), n_shingles, component_id, kept of each row. One row of a group is kept, or a row and
    its repetitions: the one with the smallest identifier, then hash. Rows without shingles are kept."""
    held, held_path = store(sketches(docs, k, id_col, text_col), "sketches")
    slim = held.select("id", "at", "n_shingles", "digest")
    grouped = held.where("n_shingles > 0").groupBy("digest").agg(F.min(F.struct(label("id").alias("label"), "at", "n_shingles", "signature")).alias("c"))
    base, _ = store(grouped.select("digest", "c.*", (F.lit(SPARE) + F.monotonically_increasing_id()).alias("spare")), "classes")
    twice, twice_path = store(base.groupBy("label").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("label", F.lit(True).alias("twice")), "twice")
    own = F.col("twice").isNull() & (F.col("label") < SPARE)
    classes = base.join(twice, "label", "left").withColumn("id", F.when(own, F.col("label")).otherwise(F.col("spare"))).drop("twice", "spare")
    made: list[str] = []
    rough, rough_path = store(candidates(classes, percent), "candidates")
    clusters, clusters_path = store(connected_components(rough, made=made), "clusters")
    drop(spark, rough_path, *made)
    sized = clusters.withColumnRenamed("component", "cluster").withColumnRenamed("node", "id").join(classes.select("id", "label", "at", "n_shingles"), "id")
    total = sized.groupBy("cluster").agg(F.count(F.lit(1)).alias("rows"), F.sum("n_shingles").alias("shingles"))
    large, large_path = store(total.where((F.col("rows") > SMALL_ROWS) | (F.col("shingles") > SMALL_SHINGLES)).select("cluster"), "large")
    wanted = sized.join(large.withColumn("is_large", F.lit(True)), "cluster", "left").select("id", "label", "at", "cluster", F.coalesce("is_large", F.lit(False)).alias("is_large"))
    members, members_path = store(_with_sets(docs, wanted, k, id_col, text_col), "members")
    links, links_path = store(_small_links(members.where("NOT is_large"), percent), "links")
    used = [links_path, clusters_path, large_path, members_path]
    if not large.isEmpty():
        many = members.where("is_large").drop("is_large").join(classes.select("id", "signature"), "id")
        window, window_path = store(_large_links(many, percent), "window-links")
        links, used = links.union(window), [*used, window_path]
        rest, rest_path = store(_open_members(many, window), "open")
        if not rest.isEmpty():
            sharing, sharing_path = store(_sharing(rest, percent), "sharing")
            exact, exact_path = store(_rest_links(sharing, percent), "rest-links")
            links, used = links.union(exact), [*used, exact_path]
            drop(spark, sharing_path)
        drop(spark, rest_path)
    reached, reached_path = store(connected_components(links, made=used), "components")
    node = classes.select("digest", F.col("id").alias("node"), F.struct("label", "at").alias("own"))
    joined = reached.join(node, "node")
    linked = joined.join(joined.groupBy("component").agg(F.min("own").alias("rep")), "component").select("digest", "rep")
    named, _ = store(node.select("digest", "own").join(linked, "digest", "left").select("digest", F.coalesce("rep", "own").alias("rep")), "named")
    drop(spark, *used, reached_path, twice_path)
    out = slim.join(named, "digest", "left")
    component = F.when(F.col("rep.label") < NONE, F.col("rep.label")).otherwise(F.col("id"))
    first = F.col("rep").isNull() | ((label("id") == F.col("rep.label")) & (F.col("at") == F.col("rep.at")))
    return out.select("id", "at", "n_shingles", component.alias("component_id"), first.alias("kept"))
