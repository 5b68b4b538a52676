import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")
P = pytest.importorskip("public_tokenizers")

from tesserae.llm import bpe_codec, packing, sharding, sstable, token_counts  # noqa: E402
from tesserae.llm.bpe import Decoder  # noqa: E402
from tesserae.llm.common import store, scratch  # noqa: E402
from tesserae.llm.tokens import BYTE, WORD, Encoder  # noqa: E402

BYTES, WORDS = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
ODD = ["", " ", "\n", " \n ", "a  b", "it's 'tis 's's 'll'LL don't we'vee 're", "x!'s", " 's", "\n's", "12 3.4½ ①",
       "a<|endoftext|>b <|endoftext|>", "<|startoftext|> hi", "ΣΑΣ İstanbul ﬁ é", " x  y\x85z\x1c q", "日本 テ 🙂🙂 'sa", "a\x00b", "a" * 3000, "''s", "՘Ᲊ"]


@pytest.mark.parametrize(("path", "kind"), [(BYTES, BYTE), (WORDS, WORD)])
def test_encoder_equals_library(path, kind, monkeypatch):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("ab sStTrelvmd'  \n\t !12.é日́Σ") for _ in range(rng.randrange(60))) for _ in range(1500)]
    library, own = tokenizers.Tokenizer.from_file(path), Encoder(path, kind)
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    decode = Decoder(library).decode
    for block in (1 << 20, 16):
        monkeypatch.setattr("tesserae.llm.tokens.BLOCK", block)
        ids, at = own.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == expected
    assert [decode(e) for e in expected] == [library.decode(e, skip_special_tokens=False) for e in expected]


def test_colliding_word_sums_fall_back_to_texts(monkeypatch):
    own = Encoder(BYTES)
    monkeypatch.setattr(type(own.cutter), "_sums", staticmethod(lambda code, begin, end: np.zeros(len(begin), np.uint64)))
    ids, _ = own.encode(["the cat and the dog"])
    assert ids.tolist() == tokenizers.Tokenizer.from_file(BYTES).encode("the cat and the dog").ids


def expected_ids(rows, path):
    library = tokenizers.Tokenizer.from_file(path)
    return [(r[0], library.encode(r[1] or "", add_special_tokens=False).ids) for r in rows]


def le(ids):
    return np.array(ids, "<u4").tobytes()


def test_codec(docs, rows, no_docs):
    got = sorted(tuple(r) for r in bpe_codec.coded(docs, WORDS, ("n_tokens", "ids_sha256", "decoded_sha256", "decoded", "ids")).collect())
    library = tokenizers.Tokenizer.from_file(WORDS)
    want = []
    for i, ids in expected_ids(rows, WORDS):
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(le(ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), text, ids))
    assert got == sorted(want)
    assert bpe_codec.coded(no_docs, WORDS).count() == 0


def test_token_counts(docs, rows, no_docs):
    lengths = [len(ids) for _, ids in expected_ids(rows, BYTES)]
    sums = token_counts.suffix_sums(token_counts.histogram(token_counts.lengths(docs, BYTES))).cache()
    got = {r["n_tokens"]: r for r in sums.collect()}
    assert {k: r["n_docs"] for k, r in got.items()} == Counter(lengths)
    for k, r in got.items():
        assert r["docs_at_least"] == sum(n >= k for n in lengths)
        assert r["tokens_at_least"] == sum(n for n in lengths if n >= k)
        assert r["truncated_total"] == sum(min(n, k) for n in lengths)
    for limit, kept, cut in token_counts.truncated_totals(sums, [0, 7, 50, 10**6]).collect():
        assert (kept, cut) == (sum(min(n, limit) for n in lengths), sum(n > limit for n in lengths))
    for share, n in token_counts.quantiles(sums, [0.0, 0.5, 0.9, 1.0]).collect():
        assert n == min(k for k in lengths if sum(x <= k for x in lengths) >= share * len(lengths))
    assert token_counts.suffix_sums(token_counts.histogram(token_counts.lengths(no_docs, BYTES))).count() == 0


def test_packing(spark, docs, rows, no_docs):
    width = 64
    got = packing.packed(spark, docs, BYTES, width=width).collect()
    own = defaultdict(list)
    for i, ids in expected_ids(rows, BYTES):
        own[i].append([*ids, 0])
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        assert r["ids_crc32"] == zlib.crc32(le(r["ids"])) and r["length"] == len(r["ids"])
        by_doc[r["id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, copies in own.items():
        assert {tuple(x) for x in copies} == {tuple(copies[0])}
        for r in by_doc[i]:
            assert r["ids"] == copies[0][r["start"] : r["start"] + r["length"]] and r["doc_tokens"] == len(copies[0])
        assert sum(r["length"] for r in by_doc[i]) == len(copies) * len(copies[0])
    assert sorted(by_sequence) == [*range(len(by_sequence))]
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= width
    total = sum(len(x) for copies in own.values() for x in copies)
    assert len(by_sequence) <= -(-total // width) + 3
    assert packing.packed(spark, no_docs, BYTES).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_fill_is_closest(seed):
    rng = random.Random(seed)
    counts, room = {rng.randrange(1, 30): rng.randrange(1, 4) for _ in range(5)}, rng.randrange(1, 60)
    reach = {0}
    for k, n in counts.items():
        reach = {s + j * k for s in reach for j in range(n + 1)}
    got = packing.fill(counts, room)
    assert sum(k * m for k, m in got.items()) == max(s for s in reach if s <= room)
    assert all(m <= counts[k] for k, m in got.items())


def test_token_tables(spark, docs, rows, no_docs, monkeypatch):
    monkeypatch.setattr(sstable, "BLOCK_BYTES", 400)
    folder = scratch(spark, "t")
    listed = sstable.write(docs, folder, BYTES, 2)
    got = sstable.with_global_start(sstable.read(spark, folder), listed).orderBy("start").collect()
    want = sorted(((i, [*ids, 2]) for i, ids in expected_ids(rows, BYTES)), key=lambda x: x[0])
    assert [(r["id"], r["ids"]) for r in got] == want
    assert [r["start"] for r in got] == np.concatenate(([0], np.cumsum([len(x) for _, x in want])[:-1])).tolist()
    assert all(r["ids_crc32"] == zlib.crc32(le(r["ids"])) and r["n_tokens"] == len(r["ids"]) for r in got)
    assert sstable.written(spark, no_docs, BYTES, 2).count() == 0


def test_table_lookup():
    w = sstable.Writer()
    for i in [None, -5, 1, 1, 7, *range(100, 3000, 3)]:
        w.add(sstable.key_of(i), np.array([1, i % 97 if i is not None else 70_000], np.uint32))
    t = sstable.Table(w.finish())
    assert len(t.get(1)) == 2 and len(t.get(None)) == 1 and t.get(-5)[0].tolist() == [1, 92]
    assert t.get(101) == [] and all(len(t.get(i)) == 1 for i in range(100, 3000, 3))
    assert t.n_docs == 972 and t.n_ids == 1944
    broken = bytearray(w.finish())
    broken[3] ^= 1
    with pytest.raises(ValueError):
        sstable.Table(bytes(broken)).get(None)


def test_lookup_opens_one_file_and_one_block(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(sstable, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(sstable, "FILE_BYTES", 4000)
    folder = scratch(spark, "t")
    listed = sstable.write(docs, folder, BYTES, 2)
    sstable._put(folder, "part-000000-0000-lost.sst", b"what a lost attempt left behind")  # in no list
    sizes = {f.split("/")[-1]: n for f, n in ((r["path"], r["length"]) for r in spark.read.format("binaryFile").load(folder).select("path", "length").collect())}
    total, files = sum(sizes.values()), listed.count()
    assert files > 1
    want = defaultdict(list)
    for i, ids in expected_ids(rows, BYTES):
        want[i].append([*ids, 2])
    for i in [*want, -1, 10**6, None]:
        found, read = sstable.lookup(folder, listed, i)
        assert sorted(v.tolist() for v in found) == sorted(want.get(i, []))
        assert read <= max(sizes.values()) or len(found) > 1
        if i == 3:
            assert 0 < read < total / 2


def test_sharding_skips_files(spark, tmp_path, monkeypatch):
    """Rows of one source and language lie in few of the written folders; statistics let scans skip the rest."""
    rng = random.Random(11)
    rows = [(i, "x" * rng.randrange(1, 400), rng.choice(["en", "de", "fr", "es", None]), rng.choice(["web", "news", "code", "books"]), "s") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, shard string").drop("shard")
    placed, _ = store(sharding.shards(spark, docs, 16), "placed")
    for column in ("lang", "source"):
        met = {r["value"]: r["shards"] for r in sharding.shards_met(placed, docs, column).collect()}
        assert sum(met.values()) / len(met) <= 10 and max(met.values()) <= 13, met
    sharding.write(docs, placed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter((r["doc_id"], r["text"], r["shard"]) for r in back.collect()) == Counter((r["doc_id"], r["text"], r["shard"]) for r in docs.join(placed, docs["doc_id"] == placed["id"]).collect())
    monkeypatch.setattr(sharding, "DICTIONARY", 2)  # beyond it, values are hashed
    assert sharding.shards(spark, docs, 16).count() == 2000


def test_hilbert_neighbours_touch():
    for dims, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
        at = sharding.hilbert(grid, bits)
        assert sorted(at) == [*range(1 << bits * dims)]
        walk = grid[np.argsort(at)].astype(int)
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_shards(spark, docs, rows, no_docs, law):
    got = sharding.shards(spark, docs, 16, law).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r["id"], r["size"], r["text_crc32"]) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append((r["slot"], r["curve"], r["size"]))
    assert set(by) <= set(range(16))
    last = -1
    for s in sorted(by):
        assert [x[0] for x in sorted(by[s])] == [*range(len(by[s]))]
        assert last <= min(x[1] for x in by[s])
        last = max(x[1] for x in by[s])
    if law == "rows":
        counts = [len(by[s]) for s in range(16)]
        assert max(counts) - min(counts) <= 1
    else:
        sizes = [sum(x[2] for x in by[s]) for s in range(16)]
        assert max(sizes) - sum(sizes) / 16 <= max(r["size"] for r in got)
    assert sharding.shards(spark, no_docs, 16, law).count() == 0
