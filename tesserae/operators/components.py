"""Connected components of an edge table: forests within tasks, then alternating stars on what is left.

Each task unites the edges that it holds and points every node to the least node it reaches there. Most
components lie in one task, as edges come in the order of a grid, of sites or of sorted keys. A node that
several tasks point to different places ties those places together: these ties are the edges of a smaller
graph, on which alternating stars run. Large star: each node points its greater neighbours to the least
node it knows. Small star: each node points its lesser neighbours, and itself, there too. Edges never
outnumber the input's by more than a constant, the least label moves at exponential speed, and every round
is two aggregations and two joins, stored in the shared folder so that lineage stays short. Nothing is
gathered on the driver; a hub's rows are combined before they travel and its join can be split.

Null ends make no edge. Self-loops keep their node. Repeated edges change nothing, and an empty table has
no components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.storage import drop, store

BLOCK_EDGES = 1 << 20


def least_reached(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct nodes of the edges (a, b), and for each the least node of its component."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    up = np.arange(len(nodes))
    x, y = at[: len(a)], at[len(a) :]
    while len(x):
        x, y = up[x], up[y]
        apart = x != y
        x, y = x[apart], y[apart]
        np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
        while True:
            further = up[up]
            if np.array_equal(further, up):
                break
            up = further
    return nodes, nodes[up]


def _forests(edges: DataFrame) -> DataFrame:
    """node, root: for each task and block of its edges, the nodes and the least ones that they reach."""

    def run(batches):
        held, rows = [], 0

        def united():
            nodes, roots = least_reached(*(np.concatenate([h[k] for h in held]) for k in (0, 1)))
            return pa.record_batch([pa.array(nodes), pa.array(roots)], ["node", "root"])

        for b in batches:
            held.append([b.column(k).to_numpy() for k in (0, 1)])
            rows += len(b)
            if rows >= BLOCK_EDGES:
                yield united()
                held, rows = [], 0
        if rows:
            yield united()

    return edges.mapInArrow(run, "node long, root long")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    pointed = edges.join(least, "u")
    return pointed.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node points to one other, which points nowhere: the edges are the answer."""
    roles = edges.select(F.col("u").alias("n"), F.lit(1).alias("points")).union(edges.select("v", F.lit(0)))
    return roles.groupBy("n").agg(F.sum("points").alias("many"), F.min("points").alias("least")).where("many > 1 OR (many = 1 AND least = 0)").isEmpty()


def _stars(now: DataFrame, path: str) -> tuple[DataFrame, str]:
    """u, v: every node u that isn't the least of its component, and the least. Takes over the stored edges."""
    spark = now.sparkSession
    while not _settled(now):
        after, after_path = store(_small(_large(now)), "stars")
        drop(spark, path)
        now, path = after, after_path
    return now, path


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", made: list[str] | None = None) -> DataFrame:
    """node, component (its least node) for every node that has an edge. The paths of the tables that the
    result reads are appended to `made`, so that a caller who has stored the result can drop them."""
    made = [] if made is None else made
    spark = edges.sparkSession
    pairs = edges.select(F.col(src).cast("long"), F.col(dst).cast("long")).where(F.col(src).isNotNull() & F.col(dst).isNotNull())
    forests, forests_path = store(_forests(pairs), "forests")
    nodes, nodes_path = store(forests.groupBy("node").agg(F.min("root").alias("root"), F.max("root").alias("top")), "nodes")
    made.append(nodes_path)
    found = nodes.select("node", F.col("root").alias("component"))
    torn = nodes.where("root < top")
    if torn.isEmpty():
        drop(spark, forests_path)
        return found
    least = torn.select("node", F.col("root").alias("v"))
    ties, ties_path = store(forests.join(least, "node").where("root > v").select(F.col("root").alias("u"), "v").distinct(), "ties")
    drop(spark, forests_path)
    stars, stars_path = _stars(ties, ties_path)
    made.append(stars_path)
    return found.join(stars.select(F.col("u").alias("component"), "v"), "component", "left").select("node", F.coalesce("v", "component").alias("component"))
