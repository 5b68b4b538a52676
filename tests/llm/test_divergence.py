import random
import re
from collections import Counter, defaultdict

import numpy as np

from tesserae.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, g int, block string, term string"


def brute_force(rows, least=10, most=10):
    docs = [(t or "", lang or "", s or "") for _, t, lang, s in rows]
    words = lambda t: [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t)]
    out = []
    for lang in {d[1] for d in docs}:
        mine = [d for d in docs if d[1] == lang]
        df, count = Counter(w for t, _, _ in mine for w in set(words(t))), defaultdict(Counter)
        kept = {w for w, n in df.items() if n >= least}
        for t, _, s in mine:
            count[s].update(w for w in words(t) if w in kept)
        share = lambda c: {w: 1 + 10**9 * (c[w] + 2) // (sum(c.values()) + 2 * len(kept)) for w in kept}
        apart = lambda p, q: (p - q) ** 2 // (p + q)
        p, q = {s: share(c) for s, c in count.items()}, share(sum(count.values(), Counter()))
        for s in count:
            pairs = [(-sum(apart(p[s][w], p[o][w]) for w in kept), o.encode()) for o in count if o != s]
            terms = [(-apart(p[s][w], q[w]), w.encode()) for w in kept if count[s][w] and p[s][w] > q[w]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:most])):
                out += [(lang, s, part, item.decode(), -v, k + 1) for k, (v, item) in enumerate(found)]
    return sorted(out)


def invented(n=260, seed=3):
    rng = random.Random(seed)
    stock = ["Über", "über", "naïve", "a", "B", "zed", "don't", "x1y", "日本", *(f"w{chr(97 + k)}{chr(97 + j)}" for k in range(8) for j in range(5))]
    rows = []
    for i in range(n):
        source = rng.choice(["s1", "s1", "s1", "s2", "s3", None, "ß", ""])
        lang = rng.choice(["en", "en", "en", "de", None])
        text = rng.choice([None, "", "12 34", " ".join(rng.choices(stock, k=rng.randrange(1, 60)))] + [" ".join(rng.choices(stock[: 20 + len(source or "")], k=40))] * 6)
        rows.append((i % 200, text, lang, source))
    return [*rows, (1, "only one here", "fr", "s1"), (2, None, "fr", "s2"), (3, "", "fr", "s3"), (4, "lonely", "it", "s1")]


def audited(spark, rows, **how):
    docs = spark.createDataFrame([(*r, 1, "b", "t") for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, divergence.audit(spark, docs, **how).select("lang", "source", "part", "item", "value", "rank").collect()))


def test_equals_brute_force(spark):
    assert audited(spark, invented()) == brute_force(invented())


def test_many_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 3)
    monkeypatch.setattr(divergence, "HELD", 20)
    assert audited(spark, invented(seed=4), most=3) == brute_force(invented(seed=4), most=3)


def test_every_pair_meets_once(spark):
    for n in (1, 2, 3, 7, 8):
        group = spark.createDataFrame([("x", f"s{g}", g, n) for g in range(n)], "lang string, source string, g int, sources int")
        made = group.selectExpr("lang", "0 AS block", "g", "0L AS total", "1L AS terms", "1 AS width").withColumn("data", divergence.F.lit(divergence._packed(np.array([], np.int64), np.array([], np.int64))))
        met = [(r["g"], r["other"]) for r in divergence.meetings(made, group).collect()]
        assert sorted(met) == [(a, b) for a in range(n) for b in range(n) if a != b]


def test_exact_shares():
    for c, total, terms in ((0, 10, 3), (5, 7, 1), (9 * 10**14, 9 * 10**15 - 10, 4), (10**15, 9 * 10**15 - 10, 4)):
        assert int(divergence.share(c, total, terms)) == 1 + 10**9 * (c + 2) // (total + 2 * terms)


def test_no_documents(spark, no_docs):
    assert divergence.audit(spark, no_docs).count() == 0
