"""Embedding whitening: distributed covariance, own symmetric eigensolver, projection on leading components.

    integers     every entry c becomes x = floor(64 * c) + 1000000; each distinct x vector once is the fit list
    moments      one pass over the fit list for n and the exact sums S, one for the covariance of
                 x - S/n (centred before multiplying); each task returns one d x d matrix, added up pairwise
                 over a tree of tasks
    eigenpairs   of that d x d matrix: Householder reduction to a tridiagonal one, bisection on Sturm
                 counts for the leading eigenvalues, inverse iteration for their vectors, vectors of
                 clustered eigenvalues made orthogonal to each other, reflections undone
    projection   the mean and the leading components (bounded: d x components) travel to every task;
                 rows are projected where they are read

How the work is spread: only distinct vectors are exchanged (a copy held by a third of all rows is
merged before the shuffle).  The driver sees matrices of the embedding's dimension, never rows.

Defined results: null vectors, and vectors with a null or non-finite entry or no entry, give no rows.
Vectors of another length than the most frequent (ties: the longer) one belong to another space
and give no rows either.  64 * c is cut at +-2^61.  Components whose eigenvalue is zero to working
precision are left out, since nothing can be divided by their deviation: a table with one distinct
vector, or none, gives no rows.  Repeated and null vec_ids are ordinary rows.  ``deviation`` is null
where it does not fit a long.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import load, scratch_table

SCALE, SHIFT = 64, 1_000_000  # fixed values of the contract
COMPONENTS = 16
EPS = float(np.finfo(np.float64).eps)
BRANCH = 64  # matrices added up by one task
MOST = 2**63 - 1


# ---------------------------------------------------------------------------------- eigensolver
def householder(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and reflection vectors of the tridiagonal form of a symmetric matrix."""
    a = np.array(matrix, dtype=np.float64)
    d, mirrors = a.shape[0], []
    for k in range(d - 2):
        x = a[k + 1:, k].copy()
        norm = np.linalg.norm(x)
        v = x.copy()
        if norm > 0:
            v[0] += np.copysign(norm, x[0])
            v /= np.linalg.norm(v)
        mirrors.append(v)
        if norm > 0:
            # A := H A H with H = I - 2 v v', applied to the trailing block
            p = a[k + 1:, k + 1:] @ v
            w = p - (v @ p) * v
            a[k + 1:, k + 1:] -= 2 * (np.outer(v, w) + np.outer(w, v))
            a[k + 1, k] = a[k, k + 1] = -np.copysign(norm, x[0])
            a[k + 2:, k] = a[k, k + 2:] = 0
    return np.diag(a).copy(), np.diag(a, 1).copy(), mirrors


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray, tiny: float) -> np.ndarray:
    """Number of eigenvalues below each point, by the signs of the LDL' pivots."""
    counts = np.zeros(len(at), np.int64)
    pivot = diagonal[0] - at
    for i in range(len(diagonal)):
        if i:
            pivot = diagonal[i] - at - off[i - 1] ** 2 / pivot
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        counts += pivot < 0
    return counts


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` greatest eigenvalues, falling, each bisected to working precision."""
    d = len(diagonal)
    around = np.zeros(d)
    around[:-1] += np.abs(off)
    around[1:] += np.abs(off)
    low, high = float(np.min(diagonal - around)), float(np.max(diagonal + around))
    size = max(abs(low), abs(high))
    tiny = EPS * EPS * size
    low, high = np.full(k, low - 2 * EPS * size), np.full(k, high + 2 * EPS * size)
    wanted = d - 1 - np.arange(k)  # so many eigenvalues lie below the one that is looked for
    while True:
        middle = 0.5 * (low + high)
        open_ = (middle > low) & (middle < high)
        if not open_.any():
            return middle
        above = sturm_counts(diagonal, off, middle, tiny) <= wanted
        low, high = np.where(open_ & above, middle, low), np.where(open_ & ~above, middle, high)


def _solve_shifted(diagonal: np.ndarray, off: np.ndarray, shift: float, rhs: np.ndarray, tiny: float) -> np.ndarray:
    """(T - shift) z = rhs by elimination with row exchanges; zero pivots become ``tiny``."""
    d = len(diagonal)
    main, up, up2, z = (diagonal - shift).tolist(), [*off.tolist(), 0.0], [0.0] * d, rhs.tolist()
    low = off.tolist()
    for i in range(d - 1):
        if abs(low[i]) > abs(main[i]):
            main[i], low[i] = low[i], main[i]
            up[i], main[i + 1] = main[i + 1], up[i]
            up2[i], up[i + 1] = up[i + 1], up2[i]
            z[i], z[i + 1] = z[i + 1], z[i]
        if abs(main[i]) < tiny:
            main[i] = tiny
        m = low[i] / main[i]
        main[i + 1] -= m * up[i]
        up[i + 1] -= m * up2[i]
        z[i + 1] -= m * z[i]
    if abs(main[d - 1]) < tiny:
        main[d - 1] = tiny
    for i in range(d - 1, -1, -1):
        s = z[i]
        if i + 1 < d:
            s -= up[i] * z[i + 1]
        if i + 2 < d:
            s -= up2[i] * z[i + 2]
        z[i] = s / main[i]
        if abs(z[i]) > 1e150:  # the direction is all that counts
            z = [x * 1e-150 for x in z]
    return np.array(z)


def tridiagonal_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) by inverse iteration; those of close eigenvalues are kept orthogonal."""
    d = len(diagonal)
    size = max(float(np.abs(diagonal).max()), float(np.abs(off).max()) if d > 1 else 0.0)
    tiny, close = EPS * size, 1e-3 * size
    out = np.zeros((d, len(values)))
    start = 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > close:
            start = j
        shift = value - (j - start) * 4 * EPS * size  # equal eigenvalues: apart by rounding
        z = np.random.default_rng(j).standard_normal(d)  # the same start at every run
        for _ in range(6):
            z /= np.linalg.norm(z)
            z = _solve_shifted(diagonal, off, shift, z, tiny)
            z /= np.linalg.norm(z)
            for _ in range(2):  # twice is enough against rounding
                z -= out[:, start:j] @ (out[:, start:j].T @ z)
        out[:, j] = z / np.linalg.norm(z)
    return out


def leading_eigenpairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` greatest eigenvalues of a symmetric matrix, falling, and their unit vectors (columns)."""
    size = float(np.abs(matrix).max())
    if size == 0:
        return np.zeros(min(k, len(matrix))), np.eye(len(matrix))[:, :k]
    diagonal, off, mirrors = householder(matrix / size)  # entries of at most 1: no under- or overflow
    values = leading_eigenvalues(diagonal, off, min(k, len(diagonal)))
    vectors = tridiagonal_vectors(diagonal, off, values)
    for k_ in range(len(mirrors) - 1, -1, -1):
        v = mirrors[k_]
        vectors[k_ + 1:] -= 2 * np.outer(v, v @ vectors[k_ + 1:])
    return values * size, vectors


# ---------------------------------------------------------------------------------- moments
def integers(rows: DataFrame) -> DataFrame:
    """``vec_id, x`` of the rows whose vector is whole and finite."""
    bound = float(2**61)
    cut = lambda c: F.greatest(F.least(F.floor(F.lit(float(SCALE)) * c), F.lit(int(bound))), F.lit(-int(bound)))
    entries = F.col("embedding").cast("array<double>")
    whole = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (rows.select("vec_id", entries.alias("embedding")).where(F.col("embedding").isNotNull() & (F.size("embedding") > 0))
            .where(whole).select("vec_id", F.transform("embedding", lambda c: (cut(F.least(F.greatest(c, F.lit(-bound)), F.lit(bound))) + F.lit(SHIFT)).cast("long")).alias("x")))


def _vectors(batch: pa.RecordBatch, d: int) -> np.ndarray:
    column = batch.column("x")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def _blocks(batches: Iterable[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches cut to about 8 MB of vectors."""
    most = max(1, (1 << 20) // d)
    for batch in batches:
        for i in range(0, batch.num_rows, most):
            piece = batch.slice(i, most)
            yield piece, _vectors(piece, d)


def _summed(parts: DataFrame, width: int) -> np.ndarray:
    """One float array per task (``m`` binary) -> their sum, added up over a tree of tasks."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            for m in batch.column("m").to_pylist():
                total += np.frombuffer(m)
        yield pa.RecordBatch.from_pydict({"m": [total.tobytes()]}, schema=pa.schema([("m", pa.binary())]))

    parts = scratch_table(parts, "whiten")
    n = parts.count()
    while n > BRANCH:
        n = -(-n // BRANCH)
        parts = scratch_table(parts.repartition(n).mapInArrow(add, "m binary"), "whiten")
    return sum((np.frombuffer(bytes(r.m)) for r in parts.toLocalIterator()), np.zeros(width))


class Whitening:
    """The fit: ``n``, exact sums ``s``, eigenvalues, components (columns), trace and identity error."""

    n: int
    s: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    def __init__(self, n: int, s: list[int]):
        self.n, self.s = n, s
        self.floor = np.array([v // n for v in s], dtype=np.int64)
        self.rest = [v % n for v in s]
        self.fraction = np.array([r / n for r in self.rest])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: the whole part exactly, then the fraction."""
        return (x - self.floor).astype(np.float64) - self.fraction

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n*x - S)^2, exact; None beyond a long."""
        near = x - self.floor
        # (n * most + n)^2 * d must fit a long for plain integer arithmetic
        most = int(np.abs(near).max(initial=0)) + 1
        if (self.n * most) ** 2 * x.shape[1] <= MOST:
            exact = near * self.n - np.array(self.rest, dtype=np.int64)
            return (exact * exact).sum(axis=1).tolist()
        sums = [sum((self.n * v - r) ** 2 for v, r in zip(row, self.rest)) for row in near.tolist()]
        return [v if v <= MOST else None for v in sums]


def fit(distinct: DataFrame, d: int, components: int) -> Whitening | None:
    """Moments, eigenpairs and the check of the whitened fit list (one row per distinct vector)."""

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(d, object), np.zeros(d, object)
        for _, x in _blocks(batches, d):
            n += len(x)
            high += (x >> 32).sum(axis=0).astype(object)  # two halves: no sum of a block can overflow
            low += (x & 0xFFFFFFFF).sum(axis=0).astype(object)
        rows = [n, *[(int(h) << 32) + int(v) for h, v in zip(high, low)]]
        yield pa.RecordBatch.from_pydict({"i": list(range(d + 1)), "v": [str(r) for r in rows]}, schema=pa.schema([("i", pa.int32()), ("v", pa.string())]))

    total = distinct.mapInArrow(sums, "i int, v string").groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    exact = {r.i: int(r.v) for r in total.collect()}  # d + 1 numbers
    if not exact.get(0):
        return None
    model = Whitening(exact[0], [exact[i + 1] for i in range(d)])

    def products(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for _, x in _blocks(batches, d):
            y = model.centred(x)
            total += y.T @ y
        yield pa.RecordBatch.from_pydict({"m": [total.tobytes()]}, schema=pa.schema([("m", pa.binary())]))

    covariance = _summed(distinct.mapInArrow(products, "m binary"), d * d).reshape(d, d) / model.n
    model.trace = float(np.trace(covariance))
    values, vectors = leading_eigenpairs((covariance + covariance.T) / 2, components)
    kept = values > d * EPS * max(model.trace, 0.0)
    model.values, model.vectors = values[kept], vectors[:, kept]
    k = int(kept.sum())
    scale = model.vectors / np.sqrt(model.values)

    def whitened(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the sums beside the products: what is left of the mean after centring (rounding only)
        total = np.zeros((k + 1, k))
        for _, x in _blocks(batches, d):
            w = model.centred(x) @ scale
            total[:k] += w.T @ w
            total[k] += w.sum(axis=0)
        yield pa.RecordBatch.from_pydict({"m": [total.tobytes()]}, schema=pa.schema([("m", pa.binary())]))

    if k:
        total = _summed(distinct.mapInArrow(whitened, "m binary"), (k + 1) * k).reshape(k + 1, k) / model.n
        model.identity_error = float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())
    return model


RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
_RESULT_ARROW = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                           ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, embedding`` -> one row per remaining row and component."""
    spark = rows.sparkSession
    vectors = integers(rows)
    lengths = vectors.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], RESULT)
    d = lengths.d
    vectors = vectors.where(F.size("x") == d)
    model = fit(scratch_table(vectors.select("x").distinct(), "whiten"), d, components)
    k = len(model.values)
    if not k:
        return spark.createDataFrame([], RESULT)
    scale, explained = model.vectors / np.sqrt(model.values), model.values / model.trace

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _blocks(batches, d):
            m = len(x)
            w = model.centred(x) @ scale
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(each),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, model.n, np.int64)),
                pa.array(model.deviations(x), type=pa.int64()).take(each),
                pa.array(w.reshape(-1)), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, model.identity_error))], schema=_RESULT_ARROW)

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(project, RESULT)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All whole embeddings on the 16 leading whitened components."""
    return whiten(load(spark, sf_dir, "embeddings"))
