import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, v string, id string"


def brute(rows, k):
    held = {}
    for r in rows:
        if r[0] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1]):
            held[r[0]] = [math.floor(1024 * float(np.float32(x))) for x in r[1]]
    out = []
    for i, q in held.items():
        if i % 10 == 0:
            scores = sorted(((-sum(a * b for a, b in zip(q, v)), j) for j, v in held.items() if j != i))[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("big", [1.0, 3e5, 3e10])
def test_search(spark, monkeypatch, big):
    """Scores below 2^53, in integers, and of components too large for 32 bits."""
    monkeypatch.setattr(topk, "SHARD_ROWS", 40)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 6)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=5).round(1) * min(big, 4e5)], i % 3, "v", "w") for i in range(150)]
    rows += [(200 + i, rows[i][1], 0, "v", "w") for i in range(30)]  # ties
    if big > 1e6:  # large in one component only, so that sums still fit a long
        rows = [(i, [big * (i % 2), *v[1:]], *rest) if i % 10 else (i, [0.5, *v[1:]], *rest) for i, v, *rest in rows]
    rows += [(300, None, 1, "v", "w"), (310, [1.0, None, 0.0, 0.0, 0.0], 1, "v", "w"), (320, [float("nan")] * 5, 1, "v", "w"), (330, [float("inf")] * 5, 1, "v", "w"), (None, [1.0] * 5, 1, "v", "w"), (340, [2.0, 1.0], 1, "v", "w"), (350, [], 1, "v", "w"), rows[0], rows[7]]
    got = topk.search(spark, spark.createDataFrame(rows, SCHEMA), F.col("id") % 10 == 0, 7)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 7)


def test_large_components(spark):
    rows = [(0, [1e6, 0.0], 0, "", ""), (1, [1e6, 0.0], 0, "", ""), (2, [3e5, 0.0], 0, "", "")]
    got = topk.search(spark, spark.createDataFrame(rows, SCHEMA), F.col("id") == 0)
    assert [tuple(r) for r in got.collect()] == [(0, 1, 1, 1048576000000000000), (0, 2, 2, 314572800000000000)]


@pytest.mark.parametrize("sign", [1.0, -1.0])
def test_scores_beyond_a_long_are_errors(spark, sign):
    rows = [(0, [1e12], 0, "", ""), (1, [sign * 1e12], 0, "", "")]
    with pytest.raises(Exception, match="for a long"):
        topk.search(spark, spark.createDataFrame(rows, SCHEMA), F.col("id") == 0).collect()


def test_fewer_rows_than_k_and_none(spark):
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.search(spark, few, F.col("id") == 0).collect()] == [(0, 1, 1, 2 * 1024 * 1024)]
    assert topk.search(spark, few.where("false"), F.col("id") == 0).count() == 0
