import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, at string"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randrange(1, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Copies, near copies, shared passages, blanks, nulls, repeated rows, a very long text; columns
    that clash with names the operators use."""
    rng = random.Random(5)
    texts = [words(rng, rng.randrange(1, 120)) for _ in range(60)]
    passage = words(rng, 110)
    texts += [words(rng, 30) + " " + passage + " " + words(rng, 20) for _ in range(4)]
    texts += [texts[0], texts[0].replace(" ", "  "), texts[1] + "\n", texts[2].upper(), "", None, " ", "\t\n", None]
    for i in range(6):
        base = texts[3 + i].split() + words(rng, 60).split()
        texts.append(" ".join(base))
        texts.append(" ".join([*base[:-1], "edited"]))
    texts += ["it's <|endoftext|> we'LL 're  \n\n x", words(rng, 4000), "a" * 3000]
    out = [(i, t, ["en", "de", None][i % 3], ["s0", "s1", None][i % 4 % 3], i, "d", "a") for i, t in enumerate(texts)]
    return [*out, out[5], out[5]]


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "d.parquet")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
