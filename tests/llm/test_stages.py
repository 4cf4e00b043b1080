"""The filtering and mixing stages on odd tables: nulls, repeated rows, columns with the names used inside."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import exact_dedup, mixing, personal_data, simhash, substring_dedup, toxicity
from strata.llm.common import words_of
from tests.llm.helpers import DOCS, docs_frame, with_clashes

CLASHES = ("_id", "_sha", "_kept", "_mine", "_source", "_at", "_take", "toxicity", "_row", "row", "_text", "_of", "_epochs", "fp", "root", "component_id")


def clashing(df):
    for name in CLASHES:
        df = df.withColumn(name, F.lit("x"))
    return with_clashes(df)


TEXTS = [(1, "a b c d", "s"), (1, "a b c d", "s"), (2, "a b c d", "t"), (None, "a b c d", "s"), (None, None, None), (None, "", "s"), (3, "q r s t u", None),
         (4, "  ", "t"), (4, "other words stand here now", "t"), (5, "w " * 3000, "s")]


def test_exact_stage(spark):
    df = clashing(docs_frame(spark, TEXTS))
    out = exact_dedup.keep_rows(df, keep="largest")
    assert out.columns == df.columns
    # of equal texts the row with the largest id, once; null counts as empty text and as the least id
    want = {(2, "a b c d"), (3, "q r s t u"), (4, "  "), (4, "other words stand here now"), (5, "w " * 3000)}
    rows = [(r.doc_id, r.text) for r in out.collect()]
    assert len(rows) == 6 and want <= set(rows) and sum(not t for _, t in rows) == 1
    assert exact_dedup.keep_rows(clashing(docs_frame(spark, []))).count() == 0


def test_near_stage_decides_per_row(spark):
    df = clashing(docs_frame(spark, TEXTS))
    out = simhash.keep_rows(df)
    assert out.columns == df.columns
    rows = [(r.doc_id, r.text) for r in out.collect()]
    # one group of "a b c d", one without words (null, empty and blank texts), the others alone
    assert sorted(r[0] for r in rows if r[1] == "a b c d") == [1]
    assert sum(not (t or "").strip() for _, t in rows) == 1 and (4, "  ") in rows
    assert len(rows) == 5
    mixed = docs_frame(spark, [(None, "a b c d"), (5, "a b c d"), (None, "x y z w v"), (None, "x y z w v")])
    assert sorted((r.doc_id is None, r.text) for r in simhash.keep_rows(mixed).collect()) == [(False, "a b c d"), (True, "x y z w v")]
    assert simhash.keep_rows(clashing(docs_frame(spark, []))).count() == 0


def test_near_stage_keeps_one_of_each_group(spark):
    rnd = random.Random(2)
    rows = []
    for g in range(30):
        words = [rnd.choice("abcdefgh") * rnd.randint(1, 4) for _ in range(60)]
        for _ in range(rnd.randint(1, 3)):
            rows.append((rnd.choice([len(rows), len(rows), None]), " ".join(words)))
    df = docs_frame(spark, rows)
    groups = {}
    for t in {t for _, t in rows}:
        groups.setdefault(t, [i for i, x in rows if x == t])
    # texts of different groups are far apart here: near groups are equal texts
    fps = {r.fp for r in simhash.fingerprints(df).collect()}
    assert all(bin((a ^ b) & (2**64 - 1)).count("1") > 3 for a in fps for b in fps if a != b)
    got = {r.text: r.doc_id for r in simhash.keep_rows(df).collect()}
    assert len(got) == simhash.keep_rows(df).count() == len(groups)
    assert all(got[t] == min((i for i in ids if i is not None), default=None) for t, ids in groups.items())


def test_mix_stage(spark):
    df = clashing(docs_frame(spark, TEXTS))
    out = mixing.take(df)
    assert out.columns == df.columns
    taken = {}
    for r in out.collect():
        assert all(r[c] == "x" for c in CLASHES)
        assert r.n_chars == len(r.text)
        taken[r.source] = taken.get(r.source, 0) + len(words_of(r.text))
    plan = {r.source: r.taken for r in mixing.mix(docs_frame(spark, TEXTS)).groupBy("source").agg(F.sum("taken").alias("taken")).collect()}
    assert all(abs(taken.get(s, 0) - n) <= 4 for s, n in plan.items())  # rows that repeat in id and size are cut alike
    assert mixing.take(clashing(docs_frame(spark, []))).count() == 0


def test_toxicity_stage(spark):
    df = clashing(docs_frame(spark, TEXTS))
    labels = spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int")
    out = toxicity.keep_clean(df, labels)
    assert out.columns == df.columns and out.count() == len(TEXTS)


def test_every_stage_of_the_pipeline(spark, tmp_path):
    df = clashing(docs_frame(spark, TEXTS))
    spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, df, str(tmp_path)).columns == df.columns, name
    packed = corpus_pipeline.STAGES[-1][1](spark, df, str(tmp_path))
    assert packed.count() >= len(TEXTS)


# ------------------------------------------------------------------------------- disguises and personal data
def test_short_disguises_are_decoded():
    import numpy as np

    model = np.zeros((toxicity.CLASSES,) * 3, np.float32)
    for token, word in (("a$$", "ass"), ("a55", "ass"), ("4$$", "ass"), ("@$$", "ass")):
        assert word in toxicity.words_behind(token, model), token
    assert "ass" in "".join(toxicity.apart("you a s s there", model))
    assert toxicity.words_behind("$$$", model) in ([], [""]) and toxicity.apart("x x x x", model) == []


OLD_AT = re.compile(r"[\w.%+-]+ ?(?:\[at\]|\(at\)|\{at\}|@| at ) ?[\w-]+(?:(?: ?(?:\[dot\]|\(dot\)|\.) ?| dot )[\w-]+)+", re.IGNORECASE)


def test_linear_rules_find_what_the_plain_rules_find():
    rnd = random.Random(3)
    for alphabet in ("ab1.@-_%é \n", "12.+ ()-a", ["a", "b", "@", " at ", "[at]", "(AT)", ".", " dot ", "[dot]", " ", "%", "x9", "-"]):
        for _ in range(4000):
            text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 30)))
            assert personal_data._emails(text) == [m.span() for m in personal_data.EMAIL.finditer(text)], text
            assert [m.span() for m in personal_data._IP.finditer(text)] == [m.span() for m in personal_data.IP.finditer(text)], text
            assert [m.span() for m in personal_data._spelled_out(text)] == [m.span() for m in OLD_AT.finditer(text)], text


@pytest.mark.parametrize("token", ["x" * 10**6, "1" * 10**6, "1." * 500_000, "a@" * 300_000, "x" * 10**6 + "@", "1.2.3.4 " * 40_000, "a@b.c " * 40_000, "." * 10**6,
                                   "a at " * 200_000, "(1" * 300_000])
def test_long_tokens_take_linear_time(token):
    t = time.process_time()
    personal_data.mentions_of(token, personal_data.base_spans(token))
    assert time.process_time() - t < 6


def test_numbers_in_lists_and_beside_seeds():
    text = "call 555-123-9876 555-123-9877 or a@b.co 555-123-9878"
    base = personal_data.base_spans(text)
    found = {text[a:b] for _, a, b, _, seed, _ in personal_data.mentions_of(text, base) if not seed}
    assert {"555-123-9876", "555-123-9877", "555-123-9878"} <= found
    assert personal_data._free([[2, 4], [6, 9]], 0, 12) == [(0, 2), (4, 6), (9, 12)]
    assert personal_data._free([[2, 4], [6, 9]], 3, 7) == [(4, 6)] and personal_data._free([], 1, 2) == [(1, 2)]


def test_rows_that_share_an_id_lose_only_what_their_own_windows_hold(spark):
    a = " ".join(f"w{i}" for i in range(30))
    b = " ".join(f"u{i}" for i in range(30))
    df = spark.createDataFrame([(1, a, "en", "s", 0), (2, a, "en", "s", 0), (2, b, "en", "s", 0)], DOCS)
    for n in (1, 3):
        got = sorted((r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.substring_dedup(df.repartition(n), with_text=False).collect())
        assert got == [(1, 30, 0), (2, 30, 0), (2, 30, 30)], n
