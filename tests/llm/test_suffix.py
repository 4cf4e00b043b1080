import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import suffix_dedup as sd
from tests.llm.helpers import SF, docs_frame, documents, with_clashes


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=40) | st.lists(st.integers(1, 250), max_size=60))
def test_suffix_array(values):
    s = np.array(values, np.int64)
    assert sd.suffix_array(s).tolist() == sorted(range(len(s)), key=lambda i: values[i:])


@given(st.lists(st.integers(1, 3), max_size=300), st.integers(1, 60))
@settings(max_examples=150, deadline=None)
def test_suffix_array_by_its_first_values(values, depth):
    order = sd.suffix_array(np.array(values * 2, np.int64), depth).tolist()
    keys = [(values * 2)[i:i + depth] for i in order]
    assert keys == sorted(keys) and sorted(order) == list(range(2 * len(values)))


def test_suffix_array_wide_keys():
    rng = np.random.default_rng(1)
    s = rng.integers(1, 2**40, 500)
    s[100:200] = s[300:400]
    values = s.tolist()
    assert sd.suffix_array(s).tolist() == sorted(range(len(s)), key=lambda i: values[i:])


@given(st.text("ab", max_size=120), st.integers(8, 12))
@settings(max_examples=60, deadline=None)
def test_classes(text, length):
    raw = text.encode()
    order, group = sd.classes(np.frombuffer(raw, np.uint8), length)
    whole = [(raw[i:i + length], g) for i, g in zip(order, group) if i + length <= len(raw)]
    assert len(set(whole)) == len({w for w, _ in whole}) == len({g for _, g in whole})


def brute(rows, length=50):
    least, out = {}, []
    raw = [((t or "").encode(), i) for i, t, *_ in rows]
    for b, i in raw:
        for k in range(len(b) - length + 1):
            if i is not None:
                least[b[k:k + length]] = min(i, least.get(b[k:k + length], i))
    for b, i in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if i is not None and least[b[k:k + length]] < i:
                gone[k:k + length] = b"\x01" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def odd_rows():
    rng = random.Random(4)
    passage = " ".join(f"päss{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, "x" * 49), (4, "x" * 50), (5, "x" * 400), (6, "x" * 51 + "y"), (None, "x" * 100), (7, "long words " * 3000),
            (8, "long words " * 100), (10, passage), (10, passage), (9, passage[:200])]
    for i in range(20, 120):
        own = "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(300)))
        a, b = sorted(rng.randrange(len(passage)) for _ in range(2))
        at = rng.randrange(len(own) + 1)
        rows.append((i, own[:at] + passage[a:b] + own[at:]))
    return rows


@pytest.mark.parametrize("parts", [1, 6])
def test_odd_rows(spark, parts):
    rows = odd_rows()
    got = sd.suffix_dedup(with_clashes(docs_frame(spark, rows).repartition(parts))).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute(rows)
    for r in got:
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and sum(b - a for a, b in r.removed) == r.n_removed


def test_small_batches(spark, monkeypatch):
    monkeypatch.setattr(sd, "BATCH_BYTES", 500)
    monkeypatch.setattr(sd, "SORT_BYTES", 2000)
    rows = odd_rows()
    assert sorted(map(tuple, sd.suffix_dedup(docs_frame(spark, rows), with_text=False).collect()), key=str) == brute(rows)
    assert sd.suffix_dedup(docs_frame(spark, [])).count() == 0


def test_table(spark):
    assert sorted(map(tuple, sd.op5_suffix_dedup(spark, SF).collect()), key=str) == brute(documents(spark))


def test_hot_anchor_is_split(spark, monkeypatch):
    monkeypatch.setattr(sd, "SORT_BYTES", 4000)
    rng = random.Random(5)
    own = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = "".join(rng.choice("klmnopqrst") for _ in range(300))
    rows = [(i, own(60) + passage + own(60)) for i in range(400)] + [(500 + i, own(30) + "-" * (60 + i % 7) + own(30)) for i in range(300)]
    rows += [(7, rows[7][1]), (None, rows[9][1]), (900, "ab" * 200 + own(9)), (901, "ab" * 300)]
    frame = docs_frame(spark, rows).repartition(3).select("doc_id", "text")
    largest = sd.dealt_segments(frame, 50).groupBy("anchor").agg(F.sum(F.length("text")).alias("n")).agg(F.max("n")).first()[0]
    assert largest <= 4000
    assert sorted(map(tuple, sd.suffix_dedup(frame, with_text=False).collect()), key=str) == brute(rows)
