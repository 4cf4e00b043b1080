import hashlib
import random

import numpy as np

from strata.llm import substring_dedup as sd
from tests.llm.helpers import SF, docs_frame, documents, with_clashes


def brute(rows, window=13):
    least = {}
    for i, text, *_ in rows:
        ws = (text or "").encode().split()
        for k in range(len(ws) - window + 1):
            w = tuple(ws[k:k + window])
            if i is not None:
                least[w] = min(i, least.get(w, i))
    out = []
    for i, text, *_ in rows:
        ws = (text or "").encode().split()
        gone = [False] * len(ws)
        for k in range(len(ws) - window + 1):
            if i is not None and least[tuple(ws[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        kept = b" ".join(w for w, g in zip(ws, gone) if not g)
        out.append((i, len(ws), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_rolled_hash_is_positional():
    rng = np.random.default_rng(0)
    for window in (1, 2, 3, 5, 8, 13, 50):
        x = rng.integers(0, 2**63, 200, dtype=np.uint64)
        x[100:160] = x[20:80]
        h = sd.rolled(x, window)
        assert len(h) == 200 - window + 1 and (h[100:160 - window + 1] == h[20:80 - window + 1]).all()
        assert len(np.unique(h)) == len({tuple(x[i:i + window].tolist()) for i in range(len(h))})
    assert len(sd.rolled(np.zeros(3, np.uint64), 4)) == 0


def odd_rows():
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, "w " * 12), (4, "w " * 13), (5, "w " * 40), (6, "W " * 40), (None, "w " * 40), (8, "w\x0bw\x1cw " * 30),
            (9, "long " * 30_000), (10, passage), (10, passage)]
    for i in range(20, 160):
        words = [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(80))]
        at = rng.randrange(len(words) + 1)
        part = passage.split()[rng.randrange(30):]
        rows.append((i, " \n ".join(words[:at] + part + words[at:])))
    return rows


def test_odd_rows(spark, monkeypatch):
    rows = odd_rows()
    df = with_clashes(docs_frame(spark, rows).repartition(6))
    got = sd.substring_dedup(df).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == brute(rows)
    for r in got:
        assert hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 and sum(b - a for a, b in r.removed) == r.n_removed
    assert sd.substring_dedup(docs_frame(spark, [])).count() == 0


def test_one_batch(spark):
    rows = odd_rows()
    got = sd.substring_dedup(docs_frame(spark, rows).coalesce(1), with_text=False)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_table(spark):
    assert sorted(map(tuple, sd.op6_substring_dedup(spark, SF).collect()), key=str) == brute(documents(spark))
