"""Every registered corpus query on the smallest tables, columns and values, against brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest

tokenizers = pytest.importorskip("tokenizers")
P = pytest.importorskip("public_tokenizers")

from tesserae.llm.queries import QUERIES  # noqa: E402
from tests.llm import test_near_dedup, test_suffix_dedup, test_topk  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return {t: [tuple(r) for r in spark.read.parquet(f"{SF}/{t}.parquet").select(*c).collect()] for t, c in (("documents", ("doc_id", "text")), ("embeddings", ("vec_id", "embedding")))}


def run(spark, name, *columns):
    df = QUERIES[name](spark, SF)
    assert [f"{c} {dict(df.dtypes)[c]}" for c in (x.split()[0] for x in columns)] == list(columns)
    return [tuple(r) for r in df.select(*(c.split()[0] for c in columns)).collect()]


def le(ids):
    return b"".join(i.to_bytes(4, "little") for i in ids)


def encoded(tables, vocabulary):
    library = tokenizers.Tokenizer.from_file(P.path(vocabulary))
    return library, {i: library.encode(t or "", add_special_tokens=False).ids for i, t in tables["documents"]}


def test_op1(spark, tables):
    got = run(spark, "op1_near_dedup", "doc_id bigint", "n_shingles bigint", "component_id bigint", "kept boolean")
    assert sorted(got) == [(i, n, c, i == c) for i, n, c in test_near_dedup.brute(tables["documents"], 3, 85)]


def test_op2(spark, tables):
    _, ids = encoded(tables, "byte_bpe_50k.json")
    lengths = [len(x) for x in ids.values()]
    rows = QUERIES["op2_token_counts"](spark, SF).collect()
    assert {r["n_tokens"]: r["n_docs"] for r in rows} == Counter(lengths)
    for r in rows:
        n = r["n_tokens"]
        assert r["docs_at_least"] == sum(x >= n for x in lengths) and r["tokens_at_least"] == sum(x for x in lengths if x >= n)
        assert r["docs_below"] == sum(x < n for x in lengths) and r["truncated_total"] == sum(min(x, n) for x in lengths)


def test_op3(spark, tables):
    library, ids = encoded(tables, "word_bpe_49k.json")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    got = run(spark, "op3_bpe", "doc_id bigint", "n_tokens bigint", "ids_sha256 string", "decoded_sha256 string")
    assert sorted(got) == sorted((i, len(x), sha(le(x)), sha(library.decode(x, skip_special_tokens=False).encode())) for i, x in ids.items())


def test_op4(spark, tables):
    got = run(spark, "op4_topk", "query_id bigint", "rank int", "vec_id bigint", "score bigint")
    assert sorted(got) == sorted(r for r in test_topk.brute(tables["embeddings"], 10) if r[0] % 100 == 0)


def test_op5(spark, tables):
    _, ids = encoded(tables, "byte_bpe_50k.json")
    ids = {i: [*x, 0] for i, x in ids.items()}
    got = run(spark, "op5_packing", "doc_id bigint", "start bigint", "length bigint", "ids_crc32 bigint", "doc_tokens bigint", "sequence_id bigint", "offset bigint")
    pieces, places = defaultdict(list), defaultdict(list)
    for i, start, length, crc, n, sequence, offset in got:
        assert n == len(ids[i]) and crc == zlib.crc32(le(ids[i][start : start + length]))
        pieces[i].append((start, length))
        places[sequence].append((offset, length))
    for group, whole in ((pieces, {i: len(x) for i, x in ids.items()}), (places, None)):
        for key, parts in group.items():
            end = 0
            for a, n in sorted(parts):
                assert a == end
                end += n
            assert end == whole[key] if whole else end <= 1024
    assert set(pieces) == set(ids)


def test_op6(spark, tables):
    squeezed = {i: "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r") for i, t in tables["documents"]}
    groups = defaultdict(list)
    for i, t in tables["documents"]:
        groups[squeezed[i]].append((-len(t or ""), i))
    got = run(spark, "op6_exact_dedup", "doc_id bigint", "keep_id bigint", "group_size bigint", "kept boolean", "text_sha256 string")
    assert sorted(got) == sorted((i, k := min(groups[s])[1], len(groups[s]), i == k, hashlib.sha256(s.encode()).hexdigest()) for i, s in squeezed.items())


def test_op7(spark, tables):
    _, ids = encoded(tables, "byte_bpe_50k.json")
    want, start = [], 0
    for i in sorted(ids):
        x = [*ids[i], 2]
        want.append((i, start, len(x), zlib.crc32(le(x))))
        start += len(x)
    assert sorted(run(spark, "op7_token_tables", "doc_id bigint", "start bigint", "n_tokens bigint", "ids_crc32 bigint")) == want


def test_op8(spark, tables):
    got = run(spark, "op8_hilbert_shards", "doc_id bigint", "size bigint", "text_crc32 bigint", "law string", "shard int", "slot bigint", "grown_shard int")
    raw = {i: (t or "").encode() for i, t in tables["documents"]}
    assert sorted(r[:3] for r in got) == sorted((i, len(b) + 1, zlib.crc32(b)) for i, b in raw.items())
    slots = defaultdict(list)
    for _, _, _, law, shard, slot, grown in got:
        assert law == "rows" and grown is None
        slots[shard].append(slot)
    assert sorted(slots) == [*range(16)] and all(sorted(s) == [*range(len(s))] for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_op9(spark, tables):
    got = run(spark, "op9_toxicity", "doc_id bigint", "held_out boolean", "score double", "predicted int")
    assert sorted(r[0] for r in got) == sorted(i for i, _ in tables["documents"])
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= s <= 1 and p == int(s >= 0.5) for i, h, s, p in got)


def test_op10(spark, tables):
    got = run(spark, "op10_suffix_dedup", "doc_id bigint", "n_bytes bigint", "n_removed bigint", "n_spans bigint", "kept_sha256 string")
    assert sorted(got) == [r[:5] for r in test_suffix_dedup.brute(tables["documents"], 400)]


def test_a_task_gives_back_what_it_took():
    from tesserae.llm.common import returning

    pins = []

    def taken():
        return int(open("/proc/self/statm").read().split()[1]) * 4 / 1024

    def run(batches):
        for b in batches:
            many = [bytes(1000) for _ in range(200_000)]
            pins.append(many[-1])  # freed memory below stays with the process until it is asked for
            yield b

    before = taken()
    assert list(returning(run)([1, 2])) == [1, 2]
    assert taken() - before < 50
