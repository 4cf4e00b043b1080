"""Language identification: features and training against plain loops, held-out accuracy, calibration."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import lang_id as li
from tests.llm.helpers import DOCS, with_clashes

SF = "/root/testdata/sf0.01"
GRAMS = li.Grams()


def plain_counts(text, bits=li.BITS):
    out, last = " ", " "
    for c in (text or "").lower():
        c = c if c.isalpha() else " "
        out += "" if c == " " == last else c
        last = c
    out += "" if last == " " else " "
    found = {}
    if not out.strip():
        return found
    for n in li.SIZES:
        for i in range(len(out) - n + 1):
            h = n
            for c in out[i:i + n]:
                h = (h * 0x110000 + ord(c)) % 2**64
            place = (h * 0x9E3779B97F4A7C15 % 2**64) >> (64 - bits)
            found[place] = found.get(place, 0) + 1
    return found


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1 << 20])
def test_counts_against_plain_loop(monkeypatch, piece):
    monkeypatch.setattr(li, "PIECE", piece)
    for text in ("", None, "  ", "123 -", "Hello,  World!", "ÀÉ ßİx", "a", " a b  c ", "x1y2\n\n\tz" * 5, "\U0001F600 ok \ud800 q"):
        places, counts = GRAMS.counts(text)
        assert dict(zip(places.tolist(), counts.tolist())) == plain_counts(text), repr(text)


def test_leader_against_plain_loop():
    rng = np.random.default_rng(0)
    rows = [(np.unique(rng.integers(0, 6, 4)), int(rng.integers(0, 3))) for _ in range(60)]
    rows = [(p, rng.random(len(p)), y) for p, y in rows]
    leader = li.Leader(3, 6, alpha=0.3, beta=1.0, l1=0.1, l2=0.2)
    z, n = [[0.0] * 3 for _ in range(7)], [[0.0] * 3 for _ in range(7)]

    def weight(i, k):
        if abs(z[i][k]) <= 0.1:
            return 0.0
        return -(z[i][k] - math.copysign(0.1, z[i][k])) / ((1.0 + math.sqrt(n[i][k])) / 0.3 + 0.2)

    for p, x, y in rows:
        leader.learn(p, x, y)
        at = [*zip(p.tolist(), x.tolist()), (6, 1.0)]
        logits = [sum(weight(i, k) * v for i, v in at) for k in range(3)]
        e = [math.exp(v) for v in logits]
        old = {(i, k): weight(i, k) for i, _ in at for k in range(3)}
        for i, v in at:
            for k in range(3):
                g = v * (e[k] / sum(e) - (k == y))
                rate = (math.sqrt(n[i][k] + g * g) - math.sqrt(n[i][k])) / 0.3
                z[i][k] += g - rate * old[i, k]
                n[i][k] += g * g
    assert np.allclose(leader.z, z) and np.allclose(leader.n, n)
    assert (leader.weights(slice(None)) == 0).any()


def test_temperature_is_the_best_of_a_grid():
    rng = np.random.default_rng(1)
    logits, labels = rng.standard_normal((300, 3)) * 4, rng.integers(0, 3, 300)
    labels[:200] = logits[:200].argmax(axis=1)
    weight = rng.random(300)

    def loss(t):
        return -(weight * np.log(li.softmax(logits / t)[np.arange(300), labels])).sum()

    t = li.temperature(logits, labels, weight)
    assert loss(t) <= min(loss(x) for x in np.geomspace(0.02, 20, 400)) + 1e-6
    assert li.temperature(np.zeros((0, 3)), np.zeros(0, int), np.zeros(0)) == 1.0


def test_document_counts_against_plain_loop(spark):
    texts = ["a b", "b c", "b", "  ", "Ab" * 40]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS).repartition(3)
    counts, n = li.document_counts(df, 12)
    want = {}
    for t in texts:
        for place in plain_counts(t, 12):
            want[place] = want.get(place, 0) + 1
    assert {i: int(c) for i, c in enumerate(counts) if c} == want and n == 4


def test_held_out_accuracy_and_score(spark):
    """Held-out rows of sf0.01: the language is found, and the score is about the share that is right."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = li.op12_language_id(spark, SF).collect()
    known = {r.doc_id: (r.lang, r.text) for r in docs.select("doc_id", "lang", "text").collect()}
    assert len(rows) == len(known)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    test = [r for r in rows if r.held_out and known[r.doc_id][0] is not None and r.lang_pred != "und"]
    right = sum(r.lang_pred == known[r.doc_id][0] for r in test) / len(test)
    assert right >= 0.97
    assert abs(right - sum(r.score for r in test) / len(test)) < 0.05
    for lang in {v[0] for v in known.values() if v[0]}:
        mine = [r for r in test if known[r.doc_id][0] == lang]
        assert sum(r.lang_pred == lang for r in mine) >= 0.9 * len(mine)


def run(spark, rows, wrap=lambda df: df):
    df = wrap(spark.createDataFrame(rows, DOCS))
    model = li.train_model(df.where(li.fold(F.col("doc_id")) != 2), bits=12, fit_rows=50)
    return {(r.doc_id, r.lang_pred, round(r.score, 9)) for r in
            li.predict(df.select("doc_id", "text", (li.fold(F.col("doc_id")) == 2).alias("held_out")), model, bits=12).collect()}


def test_defined_results(spark):
    rows = [(i, ("the cat and the dog " if i % 2 else "der hund und die katze ") * (1 + i % 3), "en" if i % 2 else "de", "s", 0) for i in range(60)]
    odd = [(900, None, "en", "s", 0), (901, "", "de", "s", 0), (902, "123 !", "en", "s", 0), (None, "the dog", None, "s", 0), (903, "die katze " * 30_000, None, None, None)]
    got = run(spark, rows + odd + rows[:5])
    by_id = {i: (lang, score) for i, lang, score in got}
    assert by_id[900] == by_id[901] == by_id[902] == ("und", 0.0)
    assert by_id[None][0] == "en" and by_id[903][0] == "de"
    assert all(by_id[i][0] == ("en" if i % 2 else "de") for i in range(60))
    assert run(spark, rows + odd + rows[:5], with_clashes) == got
    assert run(spark, []) == set()
    assert run(spark, [(1, "abc", None, "s", 3)]) == {(1, "und", 0.0)}  # nothing learned
    assert run(spark, [(1, "abc", "xx", "s", 3), (3, "abd", "xx", "s", 3)]) >= {(3, "xx", 1.0)}  # one language


def test_labels_and_source_of_scored_rows_are_no_input(spark):
    rows = [(i, "the cat and dog" if i % 2 else "der hund und die katze", "en" if i % 2 else "de", "s", 0) for i in range(60)]
    moved = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, "other", 1) for i, t, lang, _, _ in rows]
    assert run(spark, rows) == run(spark, moved)
