import math

import numpy as np
from pyspark.sql import functions as F

from strata.llm import topk_search
from tests.llm.helpers import SF


def brute(rows, k=20):
    best = [(i, [math.floor(64 * c) for c in v]) for i, v in rows if i is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for at, (q, a) in enumerate(best):
        if q % 20 == 0:
            scored = sorted((-sum(s * t for s, t in zip(a, b)), i) for n, (i, b) in enumerate(best) if n != at)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("x", F.lit(1)).withColumn("d", F.lit("y"))


def test_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted(map(tuple, topk_search.op10_topk(spark, SF).collect())) == brute(rows)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "BLOCK", 64)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 5)) * 3
    rows = [(i, (centres[i % 6] + rng.normal(size=5) * 0.1).round(3).tolist()) for i in range(400)]
    rows += [(500 + i, [0.5, 0.25]) for i in range(150)] + [(700, None), (720, []), (740, [1.0, float("nan")]), (760, [float("inf")]), (780, [None, 1.0]),
             (None, [1.0]), (800, [1.0]), (800, [1.0]), (800, [2.0, 1.0])]
    rows = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    is_query = F.col("vec_id") % 20 == 0
    assert sorted(map(tuple, topk_search.top_k(frame(spark, rows), is_query).collect())) == brute(rows)
    few = rows[:7]
    assert sorted(map(tuple, topk_search.top_k(frame(spark, few), is_query).collect())) == brute(few)
    assert topk_search.top_k(frame(spark, []), is_query).count() == 0


def test_large_components_are_scored_in_whole_numbers(spark):
    rows = [(0, [float(2**21), 1.0]), (1, [1.0, 0.5]), (2, [float(2**21) - 0.25, 3.0]), (20, [-3.0, 2.0]), (3, [float(2**27), -1.0])]
    assert sorted(map(tuple, topk_search.top_k(frame(spark, rows), F.col("vec_id") % 20 == 0).collect())) == brute(rows)
    got = topk_search.top_k(frame(spark, [(0, [1e30]), (1, [1e30]), (2, [-1e30])]), F.col("vec_id") == 0).collect()
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 2**63 - 1), (2, -2**63)]
