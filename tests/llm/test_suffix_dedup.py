import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.llm import suffix_dedup
from tesserae.llm.suffix import common_prefixes, suffix_array
from tesserae.llm.winnow import selected, stretches, widths

SCHEMA = "doc_id long, text string, key string, piece int, body int"
LENGTH = 400


def brute(rows, length, words=0):
    raw = [(r[0], (r[1] or "").encode()) for r in rows]
    count = Counter(t[k : k + length] for _, t in raw for k in range(len(t) - length + 1))
    out = []
    for i, t in raw:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if count[t[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        edges = [k for k in range(len(t) + 1) if (gone[k - 1] if k else 0) != (gone[k] if k < len(t) else 0)]
        for x, y in zip(edges[::2], edges[1::2]):
            if len(t[x:y].split()) < words:
                gone[x:y] = bytes(y - x)
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")))
    return sorted(out)


def fixture():
    rng = random.Random(2)
    text = lambda n: "".join(rng.choice("abc dé\n") for _ in range(n))
    passage, other, edge = text(900), text(500), text(400)
    while len(edge.encode()) > 400:
        edge = edge[:-1]
    edge += "x" * (400 - len(edge.encode()))
    rows = [text(rng.randrange(1500)) for _ in range(20)]
    rows += [text(rng.randrange(300)) + passage + text(rng.randrange(300)) for _ in range(8)]
    rows += [passage[:700] + text(50), passage[300:] + text(50), text(30) + other + text(600) + other, rows[3], rows[3]]
    rows += [text(20) + edge + text(20), "z" + edge, "y" + edge[:399], "ab" * 600, "q" * 399, "q" * 400, "w" * 401, "", None, "short"]
    out = [(i, t, "k", 1, 2) for i, t in enumerate(rows)]
    return [*out, out[1], out[25]]


@pytest.mark.parametrize(("shard", "stretch"), [(1_500_000, 1 << 20), (1500, 600)])
def test_removed_bytes(spark, monkeypatch, shard, stretch):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard)
    monkeypatch.setattr(suffix_dedup, "STRETCH_BYTES", stretch)
    rows = fixture()
    got = suffix_dedup.cleaned(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), LENGTH, with_text=True)
    texts = {r[0]: r[1] or "" for r in rows}
    own = [(r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], texts[r["id"]] if r["kept_text"] is None else r["kept_text"]) for r in got.collect()]
    assert sorted(own) == brute(rows, LENGTH)


@pytest.mark.parametrize(("length", "words"), [(150, 51), (120, 20), (250, 60)])
def test_other_lengths_and_words(spark, length, words):
    """Shorter strings, and runs of few words that stay; copies of a text with few words stay too."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(n) for n in (51, 50, 80, 30, 49, 52, 20)]
    rows = [(i, text(rng.randrange(60)) + " " + p + " " + text(rng.randrange(60)), "k", 1, 2) for i, p in enumerate(passages * 3)]
    rows += [(100 + i, t, "k", 1, 2) for i, t in enumerate([passages[0], passages[0], text(1) * 80, text(60), text(49)] * 2)]
    rows.append((200, text(60_000), "k", 1, 2))  # a very long text
    got = suffix_dedup.cleaned(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), length, with_text=True, words=words)
    texts = {r[0]: r[1] for r in rows}
    own = [(r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], texts[r["id"]] if r["kept_text"] is None else r["kept_text"]) for r in got.collect()]
    assert sorted(own) == brute(rows, length, words)
    assert sum(r[2] for r in own) > 1000


@pytest.mark.parametrize("words", [0, 51])
def test_copies_are_dealt_out(spark, words):
    """all rows of a text with many copies went to one task of the last join. Copies short in bytes or words stay."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    often, few, shared = [text(200), text(20), "w" * 300 + " " + "z" * 300, None], [text(200), text(20)], text(150)
    texts = [often[0]] * 1200 + often[1:2] * 100 + often[2:3] * 100 + often[3:] * 100 + few * 3
    texts += [text(9) + " " + shared + " " + text(9) for _ in range(8)] + [text(12) for _ in range(1000)]
    rng.shuffle(texts)
    rows = [(i, t, "k", 1, 2) for i, t in enumerate(texts)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        got = suffix_dedup.cleaned(spark, spark.createDataFrame(rows, SCHEMA).repartition(6), LENGTH, with_text=True, words=words)
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert max(sizes) < 1000
        own = [(r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], (texts[r["id"]] or "") if r["kept_text"] is None else r["kept_text"]) for r in got.collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sorted(own) == brute(rows, LENGTH, words)


def test_too_short_a_length(spark):
    with pytest.raises(ValueError):
        suffix_dedup.cleaned(spark, spark.createDataFrame([], SCHEMA), 20)


def test_empty_table(spark):
    assert suffix_dedup.cleaned(spark, spark.createDataFrame([], SCHEMA)).count() == 0


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(0)
    for t in range(200):
        d = rng.integers(97, 97 + rng.integers(1, 5), rng.integers(1, 80)).astype(np.uint8)
        d = np.concatenate((d, d, d[:5])) if t % 3 == 0 else d
        s, order = bytes(d), suffix_array(d)
        assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
        for k, n in enumerate(common_prefixes(d, order).tolist()):
            a, b = s[order[k - 1] :] if k else b"", s[order[k] :]
            assert a[:n] == b[:n] and (n == min(len(a), len(b)) or a[n] != b[n])


@pytest.mark.parametrize("length", [50, 150, 400])
def test_winnowing_keeps_every_repeat(length):
    rng = np.random.default_rng(1)
    gram, span = widths(length)
    for _ in range(20):
        shared = rng.integers(97, 100, length).astype(np.uint8)
        a, b = (np.concatenate((rng.integers(97, 100, x).astype(np.uint8), shared, rng.integers(97, 100, 100).astype(np.uint8))) for x in rng.integers(0, 300, 2))
        (least, own), (_, other) = selected(a, gram, span), selected(b, gram, span)
        found = stretches(np.isin(least, other), length, gram, span)
        at = len(a) - length - 100
        assert any(x <= at and at + length <= y for x, y in found)
        assert len(least) == len(a) - gram - span + 2 and set(least.tolist()) == set(own.tolist())
