import random

import pytest

tokenizers = pytest.importorskip("tokenizers")
P = pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from tests.llm import test_exact_dedup, test_near_dedup, test_suffix_dedup  # noqa: E402


def fixture():
    rng = random.Random(6)
    clean = ["".join(rng.choice("abcdefghijklm") for _ in range(rng.randrange(2, 7))) for _ in range(400)]
    text = lambda n: " ".join(rng.choice(clean) for _ in range(n))
    texts = [text(rng.randrange(1, 200)) for _ in range(60)]
    passage = text(120)
    texts += [text(150) + " " + passage + " " + text(150) for _ in range(5)]
    texts += [texts[0], " " + texts[1], texts[2].replace(" ", "\n"), "", None, " "]
    long = text(250).split()
    texts += [" ".join([*long[:-k], "end"]) for k in range(1, 6)]
    toxic = [text(30) + " idiot " + text(10) for _ in range(25)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts + toxic)]
    labels = [(i, 1, int(i >= len(texts))) for i in range(len(rows))]
    return rows, labels, len(texts)


def test_run_equals_brute_force(spark, tmp_path):
    rows, labels, n_clean = fixture()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    left = rows[:n_clean]
    stay = {b[1] for b in test_exact_dedup.brute(left)}
    left = [r for r in left if r[0] in stay]
    first = {i for i, _, component in test_near_dedup.brute(left, corpus_pipeline.SHINGLE, corpus_pipeline.PERCENT) if i == component}
    left = [r for r in left if r[0] in first]
    left = [(i, kept) for i, _, _, _, _, kept in test_suffix_dedup.brute(left, corpus_pipeline.REPEAT, corpus_pipeline.WORDS)]
    library = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = {i: [*library.encode(t, add_special_tokens=False).ids, 0] for i, t in left}
    want = {i: len(x) for i, x in ids.items()}
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"]: r["doc_tokens"] for r in got} == want
    assert sum(r["length"] for r in got) == sum(want.values())
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == len(got)
    assert {i: [t for r in sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["start"]) for t in r["ids"]] for i in want} == ids


EXTRA = ["__gone", "__of", "__key", "__kept", "__at", "id", "key", "cluster", "set", "digest", "body", "toxic", "task"]


def test_odd_tables(spark, tmp_path):
    """Extra columns of any name, a very long text, repeated rows, nulls; then no row at all."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    texts = [" ".join(word() for _ in range(40)) for _ in range(12)] + [" ".join(word() for _ in range(250_000)), None, ""]
    rows = [(i, t, "en", "s", len(t or ""), *(f"{c}{i}" for c in EXTRA)) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[0] + " more", "en", "s", 1, *EXTRA)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in EXTRA)
    docs = spark.createDataFrame(rows, schema)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    want = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got, _ = corpus_pipeline.store(stage(spark, want, str(tmp_path)), name)
        assert got.columns == docs.columns, name
        want = got
    left = {r["doc_id"]: r for r in want.collect()}
    assert sorted(left) == [*range(14)]  # blank texts are copies, the longest with the smallest id stays; the row without an id is a near copy
    assert all(r[c] == f"{c}{i}" for i, r in left.items() for c in EXTRA)
    assert left[12]["text"] == texts[12]
    pieces = corpus_pipeline.pack(spark, want, str(tmp_path)).collect()
    assert {r["doc_id"] for r in pieces} == set(left)
    none = docs.where("false")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).count() == 0, name


def test_near_copies_go_by_text(spark, tmp_path):
    """Rows that share an identifier, or have none, go each by its own text; a unique text is never lost."""
    rng = random.Random(12)
    text = lambda: [("".join(rng.choice("abcdefgh") for _ in range(6))) for _ in range(60)]
    a, b, c = text(), text(), text()
    near = lambda t, k: " ".join([*t[:-1], f"end{k}"])
    rows = [(1, near(a, 1)), (5, near(a, 2)), (5, " ".join(b)), (None, near(c, 1)), (None, near(c, 2)), (None, near(b, 3)), (None, "alone here without any copy at all"), (9, None), (9, "")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, __gone string")
    left = corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path))
    assert left.columns == docs.columns
    got = [tuple(r)[:2] for r in left.collect()]
    assert {t for _, t in got} - {near(c, 1), near(c, 2)} == {near(a, 1), " ".join(b), "alone here without any copy at all", None, ""}
    assert len([t for _, t in got if t in (near(c, 1), near(c, 2))]) == 1 and len(got) == 6
