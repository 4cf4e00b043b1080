"""Whitening against numpy's eigensolver and exact integers."""

import math

import numpy as np
import pytest
from pyspark.sql.types import ArrayType, FloatType, DoubleType, LongType, StructField, StructType

from strata.llm import whitening as wh
from tests.llm.helpers import SF, with_clashes

ROWS = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(FloatType()))])
WIDE = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(DoubleType()))])


def check(rows, got):
    """``got`` against the contract, computed plainly over (vec_id, vector) rows."""
    whole = [(i, [int(math.floor(64 * float(c))) + 1_000_000 for c in v]) for i, v in rows
             if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in whole})
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[(n * c - t) / n for c, t in zip(x, s)] for x in fit])
    cov = y.T @ y / n
    values = np.sort(np.linalg.eigvalsh(cov))[::-1]
    k = min(16, int((values > 1e-9 * values[0]).sum()))
    assert len(got) == len(whole) * k
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1
    assert got[0].identity_error < 1e-8
    explained = {r.component: r.explained for r in got}
    assert np.allclose([explained[j + 1] for j in range(k)], values[:k] / np.trace(cov), rtol=1e-9)
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    mine = {i: x for i, x in whole}
    deviations = {i: sum((n * c - t) ** 2 for c, t in zip(x, s)) for i, x in mine.items()}
    assert {i: by_id[i][1].deviation for i in mine} == deviations
    # whitened rows: inner products under V^-1 on the leading space do not depend on signs or on bases of equal eigenvalues
    distinct = {tuple(x): i for i, x in whole}
    w = np.array([[by_id[distinct[x]][j + 1].whitened for j in range(k)] for x in fit])
    assert np.abs(w.T @ w / n - np.eye(k)).max() < 1e-8
    _, vectors = np.linalg.eigh(cov)
    if k == len(values) or values[k - 1] - values[k] > 1e-6 * values[0]:
        top = vectors[:, ::-1][:, :k]
        expect = (y @ top / np.sqrt(values[:k])) @ (y @ top / np.sqrt(values[:k])).T
        assert np.allclose(w @ w.T, expect, atol=1e-6)


def test_eigensolver_against_numpy():
    rng = np.random.default_rng(7)
    tests = [rng.standard_normal((d, d)) for d in (1, 2, 3, 8, 33, 70)]
    tests = [a @ a.T for a in tests] + [np.eye(6), np.diag([5.0, 5, 5, 1, 0, 0]), np.zeros((3, 3)), 1e-200 * np.eye(4) + 0]
    q, _ = np.linalg.qr(rng.standard_normal((40, 40)))
    tests.append(q @ np.diag([9.0] * 10 + [9 - 1e-9] * 10 + [1.0] * 20) @ q.T)  # clusters
    tests.append(np.diag(np.arange(21) - 10.0) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1))  # close pairs
    for a in tests:
        a = (a + a.T) / 2
        values, vectors = wh.leading_eigenpairs(a, 16)
        k, size = len(values), max(1e-300, np.abs(a).max())
        assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:k]).max() <= 1e-12 * size * len(a)
        assert np.abs(a @ vectors - vectors * values).max() <= 1e-12 * size * len(a)
        assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12 * len(a)


def test_sturm_counts():
    a = np.diag([4.0, 1, 3, 2])
    assert wh.sturm_counts(np.diag(a), np.zeros(3), np.array([0.5, 1.5, 2.5, 9.0]), 1e-300).tolist() == [0, 1, 2, 4]


def test_rows_against_plain_numbers(spark):
    rng = np.random.default_rng(3)
    base = (rng.standard_normal((80, 5)) @ rng.standard_normal((5, 20))).astype(np.float32)  # rank 5 before rounding
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[3][1]) for i in range(200)]  # copies of one vector
    rows += [(5000, None), (5001, [None] + rows[0][1][1:]), (5002, [float("nan")] * 20), (5003, [float("inf")] + rows[0][1][1:]), (5004, [])]
    got = wh.whiten(spark.createDataFrame(rows, ROWS)).collect()
    check([r for r in rows if r[1] != []], got)
    clash = wh.whiten(with_clashes(spark.createDataFrame(rows, ROWS))).collect()
    assert sorted(map(tuple, clash)) == sorted(map(tuple, got))


def test_defined_results(spark):
    def ids(rows, schema=ROWS):
        return [(r.vec_id, r.component) for r in wh.whiten(spark.createDataFrame(rows, schema)).collect()]

    assert ids([]) == [] and ids([(1, None), (2, [])]) == []
    assert ids([(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []  # one distinct vector: nothing to divide by
    assert sorted(ids([(1, [1.0, 2.0]), (None, [2.0, 2.0]), (3, [7.0])]), key=str) == [(1, 1), (None, 1)]  # another length
    assert sorted(ids([(1, [1.0]), (1, [2.0])])) == [(1, 1), (1, 1)]
    huge = wh.whiten(spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [5.0, 9.0])], WIDE)).collect()
    assert len(huge) >= 3 and all(r.deviation is None for r in huge if r.vec_id != 3)


def test_exact_deviation_beyond_plain_integers():
    model = wh.Whitening(3, [3 * 10**6, 3 * 10**6 + 1])
    x = np.array([[10**6 + 5, 10**6 - 7], [10**6 + 2**29, 10**6]])
    want = [sum((3 * int(v) - s) ** 2 for v, s in zip(row, (3 * 10**6, 3 * 10**6 + 1))) for row in x]
    assert model.deviations(x) == want
    assert wh.Whitening(2**33, [0, 0]).deviations(np.array([[1, 1]])) == [None]


def test_query_over_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(rows, wh.op13_whitening(spark, SF).collect())


if __name__ == "__main__":
    pytest.main([__file__])
