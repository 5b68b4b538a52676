import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tesserae.llm import align
from tesserae.llm.align_codec import aligned_encoder, byte_letters, sizes
from tesserae.llm.queries import vocabulary

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


def spans(tokens):
    at, out = 0, []
    for token, data in tokens:
        out.append((at, at + len(data), token))
        at += len(data)
    return out


def brute_force(rows):
    """What the contract says, token by token with the libraries on whole texts."""
    import sentencepiece
    from tokenizers import Tokenizer

    tok, letters = Tokenizer.from_file(vocabulary(A)), byte_letters()
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary(B))
    piece = lambda k: bytes([int(sp.id_to_piece(k)[3:5], 16)]) if sp.is_byte(k) else sp.id_to_piece(k).replace("▁", " ").encode()
    found, held = [], Counter()
    for i, text in rows:
        a, b, groups, links = [], [], [], []
        if text:
            a = [(k, bytes(letters[c] for c in tok.id_to_token(k))) for k in tok.encode(" " + text, add_special_tokens=False).ids]
            b = [(k, piece(k)) for k in sp.encode(text)]
            if any(b"".join(d for _, d in x) != (" " + text).encode() for x in (a, b)):
                a, b = [], []
        sa, sb = spans(a), spans(b)
        lo = 0
        for hi in sorted({x[1] for x in sa} & {x[1] for x in sb}):
            ga, gb = ([x for x in s if lo < x[1] <= hi] for s in (sa, sb))
            groups.append(",".join(str(x[2]) for x in ga) + "|" + ",".join(str(x[2]) for x in gb))
            links += [(x[2], y[2]) for x in ga for y in gb if x[0] < y[1] and y[0] < x[1]]
            lo = hi
        found.append((i, len(a), len(b), len(groups), links, ";".join(groups)))
        held.update(set(links))
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    return [(i, na, nb, ng, len(ls), sum(held[p] == best[p[0]] for p in ls), sum(held[p] for p in ls), hashlib.sha256(text.encode()).hexdigest() if na else "") for i, na, nb, ng, ls, text in found]


ODD = [None, "", " ", "\n", " \n\nx", "a▁b", "<|endoftext|> <s> </s>", "a\x00b\r\n c\t d", "日本語テキスト\n日本", "ééé 🎉🎉  🎉\n\n", " " * 77 + "x" + " " * 40, "aaaa" * 300, "it's we'LL 're  x"]


def test_equals_brute_force(spark, rows):
    texts = [(i, r[1] if r[1] is None else r[1][:2000]) for i, r in enumerate(rows)][:60] + [(1000 + k, t) for k, t in enumerate(ODD)] + [(None, "no name"), (7, "twice the same"), (7, "twice the same")]
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in texts], "doc_id long, text string, key string, pair int").repartition(3)
    got, pairs = align.aligned(spark, docs, vocabulary(A), vocabulary(B))
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(map(tuple, got.select("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=key) == sorted(brute_force(texts), key=key)
    tops = pairs.where("best").groupBy("a_id").count().count()
    assert tops == pairs.select("a_id").distinct().count()


def test_long_documents_in_stretches(monkeypatch):
    """The machine gives the same whatever the stretches and blocks; its open state stays small."""
    coders = [aligned_encoder(vocabulary(v), s) for v, s in ((A, "a"), (B, "b"))]
    texts = [" " + "some words, ungewöhnliche Wörter & 12345 numbers\n" * 40, "", " x", " " + "abcabcabd" * 500]
    parts = [c.encode(texts) for c in coders]

    def run(stretch, swept, block):
        for name, n in (("STRETCH", stretch), ("SWEPT", swept), ("BLOCK", block)):
            monkeypatch.setattr(align, name, n)
        sweep, out = align.Sweep(*(sizes(c.table) for c in coders), 0), []
        for k in range(len(texts)):
            rows = []
            for side, (flat, offset) in enumerate(parts):
                own, at = flat[offset[k] : offset[k + 1]].astype("<u2"), 0
                for a in range(0, max(len(own), 1), stretch):
                    part = own[a : a + stretch]
                    rows.append((at, side, len(part).to_bytes(4, "little") + align._deflated(part)))
                    at += int(sizes(coders[side].table)[part].sum())
            for _, side, data in sorted(rows, key=lambda r: r[:2]):
                out += sweep.feed(k, k, side, data)
        out += sweep.finish()
        docs = [r for b in out for r in b.to_pylist() if r["pair"] is None]
        counts = Counter()
        for b in out:
            for r in b.to_pylist():
                if r["pair"] is not None:
                    counts[r["pair"]] += r["docs"]
        return [{c: r[c] for c in ("id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")} for r in docs], counts

    whole = run(1 << 16, 1 << 20, 1 << 21)
    assert [r["n_a"] for r in whole[0]] == np.diff(parts[0][1]).tolist()
    for other in ((7, 1, 1), (16, 50, 30), (100, 1 << 20, 1)):
        assert run(*other) == whole


def test_pieces_equal_the_library(rows):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary(B))
    texts = [r[1] for r in rows if r[1]] + [t for t in ODD if t and "▁" not in t]
    flat, offset = aligned_encoder(vocabulary(B), "b").encode([" " + t for t in texts])
    assert [flat[a:b].tolist() for a, b in zip(offset[:-1], offset[1:])] == sp.encode(texts, num_threads=1)


def test_no_documents(spark, no_docs):
    got, pairs = align.aligned(spark, no_docs, vocabulary(A), vocabulary(B))
    assert got.count() == 0 and pairs.count() == 0


@pytest.mark.parametrize("k", [0, 1])
def test_bad_words_are_marked(k):
    from tesserae.llm.align_codec import BAD, _checked

    ids, count = _checked(["ab", "c"], np.array([0, 1, 2], np.uint32), np.array([2, 1]), [b"a", b"b", (b"c", b"x")[k]])
    assert ids.tolist() == ([0, 1, 2], [0, 1, BAD])[k] and count.tolist() == [2, 1]
