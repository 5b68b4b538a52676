"""Exact top-k by inner product: ball trees per shard, branch and bound.

Rows are dealt to shards of about SHARD_ROWS by a hash of their identifier. Each shard's tree splits its
points at the median of the direction between two far points; a node keeps its centre and radius, and no
point of it can score more than q.centre + |q| * radius. Queries stay a table. Each one first searches the
tree of one shard, and its kth score there is shared with all others. Then blocks of about BLOCK_ROWS
queries meet groups of trees, a task for each block and group: the task searches tree after tree, takes
nodes by falling upper bound and drops a node as soon as its bound lies below every open query's kth score,
which it carries on to the next tree. Bounds are rounded upwards; scores are exact.

Vectors that are null or hold a null or non-finite component take no part, nor do rows without an
identifier. Components are scaled and floored, however large; where sums could pass 2^53 they are made in
integers. A score among the results that doesn't fit a long is an error. Shorter vectors count as padded
with zeros, empty ones too. Rows that repeat an identifier and vector count once; a query never finds its
own identifier. Ties go to the smaller identifier. Empty tables have no results. Only the two named columns
are read, so that other columns may have any name.
"""

from __future__ import annotations

import heapq
import io

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tesserae.llm.common import store

SHARD_ROWS, LEAF_ROWS, BLOCK_ROWS, GROUP_TREES = 8192, 64, 65_536, 32
#: Stands for a score below the longs.
BELOW = -(2**63) + 1


def quantised(df: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """id, v (array of double, whole numbers) of the rows that take part."""
    x = F.col(vector_col)
    sound = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    value = F.transform(x, lambda c: F.lit(scale) * c.cast("double"))
    rows = df.where(F.col(id_col).isNotNull() & F.coalesce(sound, F.lit(False)))
    # floor() of a double gives a long: beyond 2^53 every double is whole
    whole = F.transform(value, lambda c: F.when(F.abs(c) < 2.0**53, F.floor(c).cast("double")).otherwise(c))
    return rows.select(F.col(id_col).cast("long").alias("id"), whole.alias("v")).dropDuplicates()


def inner_products(q: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number vectors, as longs. Below the longs they are BELOW, beyond them
    an error."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(points).max(initial=0)) * max(1, q.shape[1])
    if most < 2.0**53:
        return np.rint(q @ points.T).astype(np.int64)
    if most < 2.0**62 and max(np.abs(q).max(), np.abs(points).max()) < 2.0**62:
        return q.astype(np.int64) @ points.astype(np.int64).T
    whole = lambda m: np.array([[int(x) for x in r] for r in m.tolist()], object).reshape(m.shape)
    exact = whole(q).dot(whole(points).T)
    if max(exact.ravel(), default=0) >= 2**63:
        raise OverflowError("a score is too large for a long")
    return np.maximum(exact, BELOW).astype(np.int64)


def _matrix(column, dims: int) -> np.ndarray:
    out = np.zeros((len(column), dims))
    for k, v in enumerate(column.to_pylist()):
        out[k, : len(v)] = v
    return out


class BallTree:
    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf_rows: int = LEAF_ROWS):
        order, nodes, todo = np.arange(len(ids)), [], [(0, len(ids), -1)]
        centres = []
        while todo:
            a, b, parent = todo.pop()
            part = points[order[a:b]]
            centre = part.mean(0)
            away = ((part - centre) ** 2).sum(1)
            me = len(nodes)
            nodes.append([a, b, -1, -1, float(away.max()) ** 0.5])
            centres.append(centre)
            if parent >= 0:
                nodes[parent][2 if nodes[parent][2] < 0 else 3] = me
            if b - a > leaf_rows and away.max() > 0:
                far = part[int(away.argmax())]
                along = part @ (part[int(((part - far) ** 2).sum(1).argmax())] - far)
                half = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(along, half)]
                todo += [(a + half, b, me), (a, a + half, me)]
        self.ids, self.points = ids[order], points[order]
        self.nodes, self.centres = nodes, np.array(centres)

    def dump(self) -> bytes:
        out = io.BytesIO()
        narrow = np.abs(self.points).max(initial=0) < 2**31
        np.savez(out, ids=self.ids, points=self.points.astype(np.int32) if narrow else self.points, nodes=np.array(self.nodes), centres=self.centres)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> BallTree:
        tree, held = cls.__new__(cls), np.load(io.BytesIO(data))
        tree.ids, tree.points, tree.centres = held["ids"], held["points"].astype(float), held["centres"]
        tree.nodes = [[int(a), int(b), int(x), int(y), r] for a, b, x, y, r in held["nodes"].tolist()]
        return tree

    def search(self, qid: np.ndarray, q: np.ndarray, best: Best) -> None:
        """Improves best for the queries q; best.kth is the score to reach."""
        norm = np.sqrt((q * q).sum(1))
        slack = 1e-9 * (norm * max(1.0, float(np.sqrt((self.points**2).sum(1).max(initial=0)))) + 1)

        def bound(node: int, rows: np.ndarray) -> np.ndarray:
            return q[rows] @ self.centres[node] + norm[rows] * self.nodes[node][4] + slack[rows]

        rows = np.arange(len(q))
        upper = bound(0, rows)
        heap = [(-float(upper.max(initial=-np.inf)), 0, rows, upper)]
        while heap:
            _, node, rows, upper = heapq.heappop(heap)
            open_ = upper >= best.kth[rows]
            rows = rows[open_]
            if not len(rows):
                continue
            a, b, left, right, _ = self.nodes[node]
            if left < 0:
                points, mine = self.points[a:b], q[rows]
                best.offer(rows, inner_products(mine, points), self.ids[a:b], qid[rows])
            else:
                for child in (left, right):
                    u = bound(child, rows)
                    heapq.heappush(heap, (-float(u.max()), child, rows, u))


class Best:
    """The k best of each query so far, and the score that a candidate must reach."""

    NONE = np.iinfo(np.int64).min

    def __init__(self, n: int, k: int, kth: np.ndarray | None = None):
        self.k, self.scores, self.ids = k, np.full((n, k), self.NONE), np.full((n, k), np.iinfo(np.int64).max)
        self.kth = np.full(n, -np.inf) if kth is None else kth.astype(float)

    def offer(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, own: np.ndarray) -> None:
        scores = np.where(ids[None, :] == own[:, None], self.NONE, scores)
        better = scores.max(1) >= self.kth[rows]
        rows, scores = rows[better], scores[better]
        if not len(rows):
            return
        s = np.concatenate((self.scores[rows], scores), 1)
        i = np.concatenate((self.ids[rows], np.where(scores == self.NONE, np.iinfo(np.int64).max, ids[None, :])), 1)
        top = np.lexsort((i, -s.astype(float) if abs(s[s != self.NONE]).max(initial=0) < 2**53 else ~s), axis=1)[:, : self.k]
        self.scores[rows], self.ids[rows] = np.take_along_axis(s, top, 1), np.take_along_axis(i, top, 1)
        last = self.scores[rows, -1]
        self.kth[rows] = np.maximum(self.kth[rows], np.where(last == self.NONE, -np.inf, last.astype(float)))


def trees(rows: DataFrame, dims: int, shards: int) -> DataFrame:
    """shard, part, tree: a crowded shard gives several trees."""

    def run(batches):
        ids, points, n, part, shard = [], [], 0, 0, TaskContext.get().partitionId()

        def tree():
            return pa.record_batch([[shard], [part], pa.array([BallTree(np.concatenate(ids), np.concatenate(points)).dump()], pa.binary())], ["shard", "part", "tree"])

        for b in batches:
            for x in range(0, len(b), SHARD_ROWS):
                piece = b.slice(x, SHARD_ROWS)
                if n + len(piece) > 2 * SHARD_ROWS:
                    yield tree()
                    ids, points, n, part = [], [], 0, part + 1
                ids.append(piece.column("id").to_numpy())
                points.append(_matrix(piece.column("v"), dims))
                n += len(piece)
        if n:
            yield tree()

    return rows.repartition(shards, "id").mapInArrow(run, "shard long, part long, tree binary")


def _searched(meetings: DataFrame, dims: int, k: int) -> DataFrame:
    """query_id, vec_id, score: the k best of each query among the trees of each meeting. meetings: a, b (which
    one it is), kind, then id, v, kth of a query (kind 0) or a tree (kind 1)."""

    def run(batches):
        now, ids, vectors, kth, best, q = None, [], [], [], None, None

        def answer():
            if best is None:
                return
            r, c = np.nonzero(best.scores != Best.NONE)
            yield pa.record_batch([pa.array(np.concatenate(ids)[r]), pa.array(best.ids[r, c]), pa.array(best.scores[r, c])], ["query_id", "vec_id", "score"])

        for batch in batches:
            a, b, kind = (batch.column(c).to_numpy() for c in ("a", "b", "kind"))
            cut = np.flatnonzero(np.concatenate(([True], (np.diff(a) != 0) | (np.diff(b) != 0) | (np.diff(kind) != 0))))
            for x, y in zip(cut.tolist(), [*cut[1:].tolist(), len(a)]):
                if (a[x], b[x]) != now:
                    yield from answer()
                    now, ids, vectors, kth, best, q = (a[x], b[x]), [], [], [], None, None
                part = batch.slice(x, y - x)
                if kind[x] == 0:
                    ids.append(part.column("id").to_numpy())
                    vectors.append(_matrix(part.column("v"), dims))
                    kth.append(part.column("kth").to_numpy())
                elif ids:
                    if best is None:
                        q = np.concatenate(vectors)
                        best = Best(len(q), k, np.concatenate(kth))
                    for data in part.column("tree"):
                        BallTree.load(data.as_py()).search(np.concatenate(ids), q, best)
        yield from answer()

    dealt = meetings.repartition("a", "b").sortWithinPartitions("a", "b", "kind")
    return dealt.select("a", "b", "kind", "id", "v", "kth", "tree").mapInArrow(run, "query_id long, vec_id long, score long")


def search(spark: SparkSession, df: DataFrame, is_query: Column, k: int = 10, scale: float = 1024.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all rows for each row of df where is_query holds."""
    rows, _ = store(quantised(df, id_col, vector_col, scale), "vectors")
    n, dims, n_queries = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0)), F.coalesce(F.sum(is_query.cast("long")), F.lit(0))).first()
    shards, blocks = max(1, -(-n // SHARD_ROWS)), max(1, -(-n_queries // BLOCK_ROWS))
    groups = max(-(-shards // GROUP_TREES), min(shards, spark.sparkContext.defaultParallelism))
    dims = max(dims, 1)
    forest, _ = store(trees(rows, dims, shards), "trees")
    queries = rows.where(is_query).groupBy("id").agg(F.min("v").alias("v"))

    def meeting(a, b, kind, **columns):
        types = {"id": "long", "v": "array<double>", "kth": "double", "tree": "binary"}
        return a.cast("long").alias("a"), b.cast("long").alias("b"), F.lit(kind).alias("kind"), *(columns.get(c, F.lit(None)).cast(t).alias(c) for c, t in types.items())

    none = F.lit(float("-inf"))
    home, zero = F.pmod(F.xxhash64("id"), F.lit(shards)), F.lit(0)
    first = _searched(queries.select(*meeting(home, zero, 0, id=F.col("id"), v=F.col("v"), kth=none)).union(forest.where("part = 0").select(*meeting(F.col("shard"), zero, 1, tree=F.col("tree")))), dims, k)
    shared = first.groupBy(F.col("query_id").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth")).where(F.col("n") == k).select("id", "kth")
    known, _ = store(queries.join(shared, "id", "left").select("id", "v", F.coalesce(F.col("kth").cast("double"), none).alias("kth")), "queries")
    each_group, each_block = (F.explode(F.sequence(F.lit(0), F.lit(m - 1))) for m in (groups, blocks))
    asked = known.select(each_group.alias("group"), F.pmod(F.xxhash64(F.col("id"), F.lit(1)), F.lit(blocks)).alias("block"), "id", "v", "kth")
    held = forest.select(F.pmod("shard", F.lit(groups)).alias("group"), each_block.alias("block"), "tree")
    meetings = asked.select(*meeting(F.col("group"), F.col("block"), 0, id=F.col("id"), v=F.col("v"), kth=F.col("kth"))).union(held.select(*meeting(F.col("group"), F.col("block"), 1, tree=F.col("tree"))))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    best = _searched(meetings, dims, k).withColumn("rank", rank).where(F.col("rank") <= k)
    fits = F.when(F.col("score") > BELOW, F.col("score")).otherwise(F.raise_error(F.lit("a score is too small for a long")).cast("long"))
    return best.select("query_id", "rank", "vec_id", fits.alias("score"))
