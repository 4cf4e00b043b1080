import itertools
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from strata.llm import toxicity
from strata.llm.common import held_out
from tests.llm.helpers import docs_frame, with_clashes

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"), ~held_out(F.col("doc_id"), 0))


@pytest.mark.parametrize("seen,word", [
    ("1d10t", "idiot"), ("m0r0n", "moron"), ("l o s e r", "loser"), ("stuuuupid", "stupid"), ("s.t.u.p.i.d", "stupid"), ("tr@$h", "trash"),
    ("p-a-t-h-e-t-i-c", "pathetic"), ("cl0wn", "clown"), ("idiooooot", "idiot"), ("w0rthle55", "worthless"), ("thing", "thing")])
def test_restore(model, seen, word):
    got = toxicity.words_behind(seen, model.characters) + toxicity.apart(seen, model.characters)
    assert word in got


def test_held_out_accuracy(spark):
    out = {r.doc_id: r for r in toxicity.op3_toxicity(spark, SF).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(out) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in out.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [(labels[i], r.predicted) for i, r in out.items() if r.held_out and labels.get(i) is not None]
    assert sum(a == b for a, b in held) >= 0.93 * len(held)
    assert sum(a and b for a, b in held) >= 0.6 * sum(a for a, _ in held)


def test_odd_rows(spark, model):
    rows = [(1, None), (2, ""), (3, "x " * 50_000), (3, "x " * 50_000), (None, "you 1d10t, you m0r0n"), (4, "日本 ퟿ 語"), (5, "a a a a a a"),
            (6, "plain words of the"), (7, "what an i d i o t and s c u m")]
    got = toxicity.score(with_clashes(docs_frame(spark, rows)), model).collect()
    by = {r.doc_id: r.toxicity for r in got}
    assert len(got) == len(rows) and by[None] >= 0.5 and by[7] >= 0.5 and by[1] == by[2] == by[6] < 0.5
    assert toxicity.score(docs_frame(spark, []), model).count() == 0


def test_no_labels(spark):
    docs = docs_frame(spark, [(1, "idiot"), (2, None)])
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    assert toxicity.keep_clean(docs, none).count() == 2
    assert toxicity.keep_clean(docs_frame(spark, []), none).count() == 0


def test_any_length(spark, model):
    spelled = " ".join("theharbourmaster" * 130 + "isanidiot")  # over 2,000 letters
    assert "idiot" in toxicity.apart(spelled, model.characters)
    stretched, chained = "st" + "u" * 80 + "pid", "-".join(["harbour"] * 12 + ["1d10t"])
    assert "stupid" in toxicity.words_behind(stretched, model.characters)
    assert "idiot" in toxicity.words_behind(chained, model.characters)
    rows = [(1, spelled), (2, f"you {stretched} m{'o' * 90}ron"), (3, chained + " m0r0n"), (4, "a plain text")]
    by = {r.doc_id: r.toxicity for r in toxicity.score(docs_frame(spark, rows), model).collect()}
    assert by[1] > by[4] and by[2] > by[4] and by[3] > by[4]


def test_long_tokens_take_linear_time(model):
    for token in ("a" + "$" * 100_000, "ab" * 100_000, "s" * 100_000, "a1" * 20_000):
        toxicity.words_behind(token, model.characters)


def test_settled_paths_change_nothing(model, monkeypatch):
    seen = "y0u-stuuupid." * 20 + " ".join("harbourmaster" * 20)
    whole = toxicity.restore(seen, model.characters)
    for n in (1, 7, 10_000):
        monkeypatch.setattr(toxicity, "SETTLE", n)
        assert toxicity.restore(seen, model.characters) == whole


def test_words_of_copied_toxic_texts_weigh_nothing(spark):
    """Thirty near copies of one toxic text are one piece of evidence against their other words."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(7))
    vocabulary = [word() for _ in range(300)]
    passage = [word() for _ in range(12)]
    texts = []
    for i in range(30):
        copied = [*passage, "idiot", rng.choice(vocabulary), str(i)]
        texts.append((" ".join(copied), 1))
    for i in range(60):
        said = rng.choices(vocabulary, k=20)
        said[rng.randrange(20)] = "idiot"
        texts.append((" ".join(said), 1))
    texts += [(" ".join(rng.choices(vocabulary, k=20)), 0) for _ in range(600)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, m) for i, (_, m) in enumerate(texts)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert "=idiot" in model.weights
    assert not [w for w in passage if f"={w}" in model.weights]


def channel(token, i):
    """What the character at ``i`` may have been, with its cost, written out from the channel's rules."""
    c, left, right = token[i], i, i
    while left and token[left - 1] == c:
        left -= 1
    while right + 1 < len(token) and token[right + 1] == c:
        right += 1
    nth, stretched = i - left + 1, right - left + 1 >= 3
    out = []
    if c in toxicity.LETTERS:
        if nth == 1:
            out.append((c, 0.0))
        elif nth == 2:
            out += [(c, toxicity.COST_REPEAT), ("", 0.0)] if stretched else [(c, 0.0), ("", toxicity.COST_TWICE)]
        else:
            out += [(c, toxicity.COST_TWICE), ("", 0.0)]
    out += [(x, toxicity.COST_VOWEL if c == "*" else toxicity.COST_SWAP) for x in toxicity.STANDS_FOR.get(c, "")]
    if c in toxicity.SEPARATORS:
        out.append(("", toxicity.COST_DROP))
    if c in " .-_":
        out.append((" ", toxicity.COST_SPACE))
    if not out or (c in toxicity.STANDS_FOR and c not in "0123456789"):
        out.append(("", toxicity.COST_LOST))
    return out


def all_paths(token, characters):
    """Every text the token may stand for with the best value of a path to it."""
    found = {}
    for path in itertools.product(*(channel(token, i) for i in range(len(token)))):
        a = b = 0
        value = 0.0
        for letter, cost in path:
            value -= cost
            if letter:
                n = 0 if letter == " " else toxicity.LETTERS.index(letter) + 2
                if n == 0 and b == 0:
                    break
                value += float(characters[a, b, n])
                a, b = b, n
        else:
            text = "".join(letter for letter, _ in path)
            value += float(characters[a, b, 0]) if b else 0.0
            found[text.strip()] = max(found.get(text.strip(), -1e9), value)
    return found


@pytest.mark.parametrize("token", ["1d10t", "a$$", "4$$", "@$$", "a55", "s.t.u", "m0r0n!", "stuuupid", "aab", "b!tch", "x*y-z", "a s s", "i--i", "#1|", "日1l", "a. .b",
                                   "..", "$", "l8r", "ee", "eee", "eeee.e", "ß!ß"])
def test_decoding_is_the_best_of_all_paths(model, token):
    paths = all_paths(token, model.characters)
    assert paths[toxicity.restore(token, model.characters)] == pytest.approx(max(paths.values()), abs=1e-3)


def test_decoding_random_tokens(model):
    rng = random.Random(11)
    for _ in range(150):
        token = "".join(rng.choice("abeilost013$@!*. -_~xé日") for _ in range(rng.randrange(1, 8)))
        paths = all_paths(token, model.characters)
        assert paths[toxicity.restore(token, model.characters)] == pytest.approx(max(paths.values()), abs=1e-3), token


def test_scores_by_plain_loops(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r.toxicity for r in toxicity.score(docs, model).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for doc_id, text in rows:
        low = (text or "").lower()
        words = {w for t in low.split() for w in toxicity.words_behind(t, model.characters)} | set(toxicity.apart(low, model.characters))
        z = model.prior
        for w in words:
            z += max([model.weights.get("=" + w, 0.0)] + [model.weights.get("^" + w[:n], 0.0) for n in (4, 5, 6) if len(w) >= n])
        assert got[doc_id] == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z)))))
