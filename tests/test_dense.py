"""Crowded cells split: 90 % of all shapes in one cell of the grid."""

import random

import pytest
from pyspark.sql import functions as F

from tesserae.operators import spatial

SCHEMA = "id long, minx double, miny double, maxx double, maxy double"


def town(n, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        x, y = (rng.uniform(0, 250), rng.uniform(0, 250)) if k % 10 else (rng.uniform(-2000, 4000), rng.uniform(-2000, 4000))
        w = rng.choice([1, 2, 5]) if k % 50 else 700  # some are wider than the cell
        rows.append((k, x, y, x + w, y + rng.choice([1, 3])))
    return [*rows, (n, None, None, None, None), (n + 1, 256.0, 256.0, 256.0, 256.0), (n + 2, 255.9999, 0.0, 256.0, 256.0)]


@pytest.mark.parametrize("most", [20, 100, 10**6])
def test_splitting_changes_nothing(spark, most):
    left, right = (spark.createDataFrame(town(n, s), SCHEMA) for n, s in ((900, 1), (700, 2)))
    pairs = lambda **how: sorted(map(tuple, spatial.pairs(left, right, 256, **how).select("l.id", F.col("r.id").alias("o")).collect()))
    dense = spatial.dense_cells(left, right, 256, most)
    found = {(r["__cx"], r["__cy"]): r["__split"] for r in dense.collect()}
    assert ((0, 0) in found) == (most < 1000) and all(s in (2, 4, 8, 16, 32, 64) for s in found.values())
    got = pairs(dense=dense)
    assert got == pairs() and len(got) == len(set(got)) > 150


def test_the_crowd_is_dealt_out(spark):
    left, right = (spark.createDataFrame(town(4000, s), SCHEMA) for s in (3, 4))
    dense = spatial.dense_cells(left, right, 256, 100)
    sizes = lambda d: d.groupBy(*(c for c in d.columns if c in ("__cx", "__cy", "__px", "__py"))).count().agg(F.max("count")).first()[0]
    laid = spatial._on_grid(left, 256, [])
    before, after = sizes(laid), sizes(spatial._parts(laid, dense, 256))
    assert before > 3500 and after < before / 15
    grown = spatial._parts(laid, dense, 256).count() / laid.count()
    assert grown < 1.8  # what splitting adds, for shapes that lie across parts
