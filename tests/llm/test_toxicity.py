import itertools
import random
import zlib

import numpy as np
import pytest

from tesserae.llm import toxicity

SCHEMA = "doc_id long, text string, lang string, source string, score double"
CLEAN = "the and of stone river winter garden letter morning window paper silver yellow harbour teacher".split()
BAD = ["stupid", "idiot", "worthless"]


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(CLEAN) for _ in range(rng.randrange(5, 60))]
        toxic = i % 5 == 0 or i % 7 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(BAD)
        rows.append((i, " ".join(words), "en", "s", 0.0))
        labels.append((i, 1, int(toxic)))
    docs, known = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([*labels, (1, 1, None)], "doc_id long, quality int, toxic int")
    return docs, known, labels, toxicity.fit(spark, docs, known)


def test_held_out_rows(data, spark):
    docs, _, labels, model = data
    score = {r["id"]: r["score"] for r in toxicity.scored(docs, model).collect()}
    held = [i for i, _, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert 40 < len(held) < 130
    assert all((score[i] >= 0.5) == bool(labels[i][2]) for i in held)
    folds = dict(docs.select("doc_id", toxicity.fold("doc_id")).collect())
    assert {i for i, f in folds.items() if f == 0} == set(held)


def test_disguises(data):
    _, _, _, model = data
    texts = ["a garden st*pid river", "the 1d10t and stone", "w-o-r-t-h-l-e-s-s paper", "s t u p i d window", "stuuuupid letter", "$tup1d"]
    assert (model.scores(texts) >= 0.5).all()
    plain = ["", None, "the garden", "a b c d e", "in 1999 the river had 12.5 windows!", "x" * 5000, "winter!", "password=1234ab"]
    assert (model.scores(plain) < 0.5).all()
    channel = toxicity.Channel(model.letters)
    same = ["the river in 1999 and 12.5 windows!", "stone garden", "winter! (paper)"]
    assert channel.restored(same) == same


def test_rejected_rows_go(spark, data):
    docs, known, labels, _ = data
    kept = toxicity.without_toxic(spark, docs, known)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _, t in labels if not t}


def test_no_labels_or_rows(spark, data):
    docs, known, _, _ = data
    assert toxicity.fit(spark, docs, known.where("false")).scores(["stupid", None]).tolist() == [0.0, 0.0]
    model = toxicity.fit(spark, docs.where("false"), known)
    assert toxicity.scored(docs.where("false"), model).count() == 0


@pytest.fixture(scope="module")
def listed(spark):
    rng = random.Random(2)
    bad = ["idiot", "loser", "trash", "pathetic", "disgusting", "stupid", "scum"]
    rows = []
    for i in range(900):
        words = [rng.choice(CLEAN) for _ in range(rng.randrange(5, 40))]
        if i % 3 == 0:
            words[rng.randrange(len(words))] = rng.choice(bad)
        rows.append((i, " ".join(words), "en", "s", 0.0))
    labels = [(i, 1, int(i % 3 == 0)) for i in range(len(rows))]
    return toxicity.fit(spark, spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


@pytest.mark.parametrize("form", ["id10t", "l053r", "l0$er", "lo$$er", "tr45h", "tr@$h", "p47h371c", "d15gu571ng", "st**id", "sc**", "\n$tupid", "(1diot", "**idiot**", "idiot2"])
def test_signs_in_runs_and_at_ends(listed, form):
    assert listed.scores([f"the garden {form} river"])[0] >= 0.5


def test_codes_and_punctuation_stay(listed):
    plain = ["the river in 1999!", "version v2.0.1 of window12", "(paper) winter! garden.", "a b c", "room 4b, 12kg, $5 each", "**garden** letter"]
    assert (listed.scores(plain) < 0.5).all()


def readings(text, i):
    """The ways to read a character as the module's docstring and constants state them."""
    ch, before, after = text[i], text[i - 1 : i], text[i + 1 : i + 2]
    stars = len(text[:i]) - len(text[:i].rstrip("*")) + len(text[i:]) - len(text[i:].lstrip("*"))
    meant = toxicity.READINGS.get(ch)
    if ch == "*" and 2 <= stars <= toxicity.MASK:
        return [(chr(c), toxicity.READ) for c in range(97, 123)] + [("", toxicity.LOSE), (" ", toxicity.LEAVE)]
    if ch == "!" and not text[i:].strip("!.,;:?)\"'"):
        return [("i", toxicity.READ), ("", toxicity.LOSE), (" ", 0.0)]
    if meant and ch != "*" and before == ch:
        return [(r, toxicity.READ) for r in meant] + [("", toxicity.KEEP), (" ", toxicity.LEAVE)]
    if meant is not None:
        return [(r, toxicity.READ) for r in meant] + [("", toxicity.LOSE if meant else toxicity.SKIP), (" ", toxicity.LEAVE)]
    if ch.isspace():
        return [("", toxicity.SKIP), (" ", 0.0)]
    if before == ch and (text[max(0, i - 2) : i] == 2 * ch or after == ch):
        return [(ch, toxicity.KEEP), ("", toxicity.SQUEEZE)]
    return [(ch, 0.0)]


def worth(model, path, cost):
    a = b = 0
    total = -cost
    for ch in path:
        c = int(toxicity.letter_class(np.array([ord(ch)]))[0])
        total += 0.0 if c == 0 and b == 0 else float(model[a, b, c])
        a, b = b, c
    return total + (float(model[a, b, 0]) if b else 0.0)


STRETCHES = ["st*pid", "1d10t", "!d!0t!!", "s t u p", "stuuupid", "sc**", "st**id", "**cum", "id***", "a.b", "x**!", "l0$$er", "5", "**", "é1a", "no!", "w-o_r", "i\td i", "aaa", "$$$", "th3***,"]


def test_search_finds_the_best_of_the_whole_lattice(data):
    model = data[3].letters
    found = dict(zip(STRETCHES, toxicity.Channel(model).search(STRETCHES)))
    for text, read in found.items():
        ways = [readings(text, i) for i in range(len(text))]
        costs = {}
        for way in itertools.product(*ways):
            path, cost = "".join(w[0] for w in way), sum(w[1] for w in way)
            costs[path] = min(cost, costs.get(path, cost))
        assert worth(model, read, costs[read]) == pytest.approx(max(worth(model, p, c) for p, c in costs.items()), abs=1e-4), (text, read)


def test_batches_pieces_and_context_do_not_change_a_reading(data):
    channel = toxicity.Channel(data[3].letters)
    alone = {s: toxicity.Channel(data[3].letters).search([s])[0] for s in STRETCHES}
    assert dict(zip(STRETCHES, channel.search(STRETCHES))) == alone
    long = "id1ot" * 50_000  # a very long token is read in pieces, whole
    read = channel.restored([long + " end", "the 1d10t\nstone", None or ""])
    assert read[0].endswith(" end") and len(read[0].split()[0]) >= 200_000 and read[1] == "the idiot\nstone" and read[2] == ""


def test_summed_evidence():
    """Two weak features decide together; one strong feature of little support doesn't decide alone."""
    hits = [[0, 1], [0], [1], [], [2]]
    w, bias = toxicity._logistic(hits, np.array([1, 0, 0, 0, 1.0]), np.array([50.0, 20, 20, 500, 1]), 3)
    score = lambda *h: 1 / (1 + np.exp(-(w[list(h)].sum() + bias)))
    assert score(0, 1) > 0.5 > max(score(0), score(1), score()) and score(2) < 0.9
    slope = [sum(n * (y - score(*h)) for h, y, n in zip(hits, [1, 0, 0, 0, 1], [50, 20, 20, 500, 1]) if k in h) - toxicity.RIDGE * w[k] for k in range(3)]
    assert np.abs(slope).max() < 1e-3  # the penalised optimum


def test_clashing_columns_and_repeated_rows(spark, data):
    _, known, _, _ = data
    rows = [(i, t, "x", 1.0) for i, t in enumerate(["the idiot stone", "the idiot stone", None, "", "river"] * 3)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, score string, toxic double")
    model = toxicity.fit(spark, odd, spark.createDataFrame([(i, int(i % 5 < 2)) for i in range(15)], "doc_id long, toxic int"))
    got = {r["id"]: r["score"] for r in toxicity.scored(odd, model).collect()}
    assert len(got) == 15 and len({got[i] for i in (0, 1, 5, 6, 10, 11)}) == 1 and got[2] == got[3]
    assert toxicity.without_toxic(spark, odd, spark.createDataFrame([], "doc_id long, toxic int")).count() == 15


def test_long_stretches_are_read_as_a_whole(data, monkeypatch):
    """Wherever a word stands in a long token, and whatever surrounds it, cutting changes nothing."""
    _, _, _, model = data
    rng = random.Random(11)
    signs = "".join(toxicity.READINGS)
    texts = ["qwertzuiop" * (k // 10) + "asdfghjkly"[: k % 10] + "-1d10t-st*pid" for k in range(0, 230, 3)]
    texts += ["".join(rng.choice(pool) for _ in range(rng.randrange(90, 700))) for pool in ("abide" + signs, signs + "a", "ab" + signs + "  ", "aab!*", "garden river") for _ in range(6)]
    texts += ["s t u p i d " * 60, "1.d.1.0.t." * 80, "*" * 300, "a*" * 200, "river" * 50 + "!!!", "stone-" * 40 + "****!"]

    def read(long):
        monkeypatch.setattr(toxicity, "LONG", long)
        return toxicity.Channel(model.letters).readings(texts)

    whole = read(10**9)
    for long in (96, 20, 5):
        assert read(long) == whole
    channel = toxicity.Channel(model.letters)
    assert all(channel.alone(t, 0) == whole[t] for t in texts)
    assert all("stupid" in whole[t] for t in texts[:77])
