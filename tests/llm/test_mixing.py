import hashlib
import random
import re
from collections import defaultdict

import pytest

from tesserae.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, key int, start long"


def brute_force(rows, share=1.5, repeats=2, weights=(5, 2, 1), quantum=32):
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    docs = [(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), md5("/".join([*([str(i)] if i is not None else []), md5(t or "")]))) for i, t, s in rows]
    size = defaultdict(int)
    for _, s, n, _ in docs:
        size[s] += n
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, open_, left = {}, set(size), share * sum(size.values())
    while open_:  # stop who is above, reshare the rest
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > repeats * size[s]}
        target.update({s: repeats * size[s] if s in over else level * weight[s] for s in open_})
        if not over:
            break
        left -= sum(repeats * size[s] for s in over)
        open_ -= over
    packets, starts = [], {}
    for s in order:
        at = 0
        for k in sorted((k for k, d in enumerate(docs) if d[1] == s and d[2]), key=lambda k: (docs[k][3], docs[k][0] or 0)):
            starts[k] = at
            at += docs[k][2]
        for turn in range(repeats):
            for k, a in starts.items():
                if docs[k][1] == s:
                    first, n = turn * size[s] + a, docs[k][2]
                    step = n if (first + n) / target[s] <= 1 else quantum
                    packets += [((first + min(b + step, n)) / target[s], order.index(s), first + min(b + step, n), min(step, n - b), k) for b in range(0, n, step)]
    budget, taken = int(share * sum(size.values())), defaultdict(int)
    for _, _, _, n, k in sorted(packets):
        taken[k] += min(n, budget)
        budget -= min(n, budget)
    return [(d[0], d[1], d[2], size[d[1]], pytest.approx(target[d[1]]), taken[k]) for k, d in enumerate(docs)]


def invented(n=150, seed=1):
    rng = random.Random(seed)
    rows = [(i, " ".join("x" * rng.randrange(1, 4) for _ in range(rng.choice([3, 30, 90, 200]))), rng.choice(["a", "a", "a", "a", "b", "c", "d", None, "é", ""])) for i in range(n)]
    return [*rows, (900, None, "b"), (901, " \t", "only blanks"), (None, "no name here", "b"), (5, "again\x0band again", "c"), rows[0], (902, "w " * 9000, "d")]


def key(r):
    return (r[0] is None, r[0] or 0, r[1] is None, r[1] or "", r[2])


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = invented(seed=seed)
    docs = spark.createDataFrame([(*r, "s", 1, 2) for r in rows], SCHEMA).repartition(3)
    out, mix = mixing.mixed(spark, docs)
    got = sorted(map(tuple, out.select("id", "source", "size", "source_size", "target", "taken").collect()), key=key)
    assert got == sorted(brute_force(rows), key=key)
    served = sorted((r["position"], r["taken"], r["finish"]) for r in mix.collect())
    assert all(a[0] + a[1] == b[0] and a[2] <= b[2] for a, b in zip(served, served[1:])) and served[0][0] == 0
    assert served[-1][0] + served[-1][1] == sum(r[5] for r in got) == int(1.5 * sum(r[2] for r in got))


def test_targets_are_met_and_nothing_more_than_twice(spark):
    docs = spark.createDataFrame([(*r, "s", 1, 2) for r in invented(400, 9)], SCHEMA)
    rows = mixing.mixed(spark, docs)[0].collect()
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    assert all(abs(sum(r["taken"] for r in v) - v[0]["target"]) <= 2 * mixing.QUANTUM for v in by.values())


def test_other_partitions_other_order_same_mix(spark):
    rows = invented(seed=5)
    make = lambda r, n: sorted(map(tuple, mixing.mixed(spark, spark.createDataFrame([(*x, "s", 1, 2) for x in r], SCHEMA).repartition(n))[0].collect()), key=key)
    assert make(rows, 2) == make(rows[::-1], 5)


def test_no_words(spark, no_docs):
    assert mixing.mixed(spark, no_docs)[0].count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert sorted((r["id"], r["size"], r["target"], r["taken"]) for r in mixing.mixed(spark, blank)[0].collect()) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
