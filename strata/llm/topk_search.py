"""Exact top-k by inner product with a pivot table.

Every vector's distances to a fixed set of pivots are computed once (the pivot table).  For a
query ``q`` and a candidate ``x`` the largest ``|d(q, p) - d(x, p)|`` over the pivots is a lower
bound of ``d(q, x)``, and with ``<q, x> = (|q|^2 + |x|^2 - d^2) / 2`` an upper bound of the score.
Candidates lie in groups of neighbours (same nearest pivot, similar distance) whose bound is
that of their ranges.  A query takes groups in the order of their bounds and stops, exactly,
when its k-th score exceeds every bound left.

Queries and candidates meet in a grid of (block of candidates, block of queries), both of
bounded size; queries, a twentieth of the rows, are what is copied to the candidate blocks.

Results for odd input: a null id, a null vector, a vector with a null or non-finite component
or without components takes no part; a shorter vector counts as padded with zeros; rows that
share an id are rows of their own, as queries and as candidates; ties go to the smaller id; fewer than k
candidates give fewer rows; an empty table gives an empty result.  A block with components so
large that doubles would round is scored in whole numbers, without bounds; scores beyond a long are
cut to it.
Only the id and the vector column are read, so others may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import load, scratch_table

PIVOTS = 16
PIVOT_SAMPLE = 512
BLOCK = 8192
GROUP = 256
EXACT = 2.0 ** 52  # squared lengths below it: sums of products are exact in doubles
_INDEX = "vec_id long, x array<long>, d array<double>"
_FOUND = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _padded(column: pa.Array, width: int | None = None) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    width = max(int(sizes.max(initial=0)), width or 0)
    out = np.zeros((len(sizes), width))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    width = max(x.shape[1], pivots.shape[1])
    x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    p = np.pad(pivots, ((0, 0), (0, width - pivots.shape[1])))
    return np.sqrt(np.maximum(0, (x * x).sum(1)[:, None] + (p * p).sum(1) - 2 * x @ p.T))


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first traversal of the sample."""
    if not len(sample):
        return sample
    chosen, gap = [sample[0]], ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < n and gap.max() > 0:
        chosen.append(sample[gap.argmax()])
        gap = np.minimum(gap, ((sample - chosen[-1]) ** 2).sum(1))
    return np.array(chosen)


def _whole_numbers(column: pa.ChunkedArray, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), dtype=object)
    for i, v in enumerate(column.to_pylist()):
        out[i, :len(v)] = v
    return out


def _search_exactly(candidates: pa.Table, queries: pa.Table, k: int, width: int) -> pa.Table:
    """The k best of a block in whole numbers of any size, one query after the other."""
    x, out = _whole_numbers(candidates["x"], width), []
    ids, rows = candidates["vec_id"].to_pylist(), candidates["row"].to_pylist()
    for q, own, row in zip(_whole_numbers(queries["x"], width), queries["vec_id"].to_pylist(), queries["row"].to_pylist()):
        scores = (x @ q).tolist()
        best = sorted((-max(-2**63, min(2**63 - 1, s)), i) for s, i, r in zip(scores, ids, rows) if r != row)[:k]
        out += [{"query_row": row, "query_id": own, "vec_id": i, "score": -s} for s, i in best]
    return pa.Table.from_pylist(out, schema=_FOUND)


def _search(k: int):
    """(candidates of a block, queries of a block) -> the k best of the block for each query."""

    def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        width = max(_padded(t["x"]).shape[1] if t.num_rows else 0 for t in (candidates, queries))
        x, q = _padded(candidates["x"], width), _padded(queries["x"], width)
        ids, own = candidates["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
        row, own_row = candidates["row"].to_numpy(), queries["row"].to_numpy()
        dx, dq = _padded(candidates["d"]), _padded(queries["d"])
        if not len(x) or not len(q):
            return _FOUND.empty_table()
        if max((x * x).sum(1).max(), (q * q).sum(1).max()) >= EXACT:
            return _search_exactly(candidates, queries, k, width)
        order = np.lexsort((dx.min(1), dx.argmin(1)))
        x, ids, dx, row = x[order], ids[order], dx[order], row[order]
        starts = np.arange(0, len(x), GROUP)
        near, far = np.minimum.reduceat(dx, starts), np.maximum.reduceat(dx, starts)
        norm = np.maximum.reduceat((x * x).sum(1), starts)
        gap = np.zeros((len(q), len(starts)))
        for p in range(dx.shape[1]):
            d = dq[:, p, None]
            np.maximum(gap, np.maximum(d - far[:, p], near[:, p] - d), out=gap)
        size = (q * q).sum(1)[:, None] + norm
        bound = (size - gap * gap) / 2 + 1e-9 * size + 1e-3  # room for rounding
        turn = np.argsort(-bound, axis=1, kind="stable")
        scores = np.full((len(q), len(x)), -np.inf)
        kth, seen, step = np.full(len(q), -np.inf), 0, 1
        while seen < len(starts):
            now = turn[:, seen:seen + step]
            wanted = np.take_along_axis(bound, now, 1) >= kth[:, None]
            if not wanted.any():
                break
            for g in np.unique(now[wanted]):
                rows = np.flatnonzero(((now == g) & wanted).any(1))
                part = slice(starts[g], starts[g] + GROUP)
                scores[rows, part] = q[rows] @ x[part].T
            if seen == 0:
                place = {v: i for i, v in enumerate(row.tolist())}
                self_at = [(r, place[v]) for r, v in enumerate(own_row.tolist()) if v in place]
            for r, c in self_at:
                scores[r, c] = -np.inf
            if scores.shape[1] > k:
                kth = np.partition(scores, -k, axis=1)[:, -k]
            seen, step = seen + step, step * 2
        r, c = np.nonzero((scores >= kth[:, None]) & np.isfinite(scores))
        s = scores[r, c]
        best = np.lexsort((ids[c], -s, r))
        r, c, s = r[best], c[best], s[best]
        first = np.searchsorted(r, r)
        top = np.arange(len(r)) - first < k
        return pa.table({"query_row": own_row[r[top]], "query_id": own[r[top]], "vec_id": ids[c[top]], "score": s[top].astype(np.int64)})

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, pivots: int = PIVOTS,
          id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best candidates of every query row.

    ``is_query`` is a condition over the column ``vec_id``.
    """
    spark = vectors.sparkSession
    odd = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & ~odd)
            .select("vec_id", F.transform("v", lambda c: F.floor(F.greatest(F.least(F.lit(scale) * c, F.lit(2.0 ** 62)), F.lit(-2.0 ** 62)))
                                          .cast("long")).alias("x")))
    # at most PIVOT_SAMPLE rows choose the pivots; every row is searched
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_SAMPLE).select("x").toArrow()
    table = choose_pivots(_padded(sample["x"]), pivots) if sample.num_rows else np.zeros((1, 1))

    def distances(batches):
        for batch in batches:
            x = _padded(batch.column("x"))
            d = _distances(x, table)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), batch.column("x"),
                pa.ListArray.from_arrays(np.arange(0, d.size + 1, d.shape[1], dtype=np.int32), d.ravel())], names=["vec_id", "x", "d"])

    index = scratch_table(rows.mapInArrow(distances, _INDEX).withColumn("row", F.monotonically_increasing_id()), "pivot-table")
    queries = index.where(is_query)
    n, m = index.count(), queries.count()
    row_blocks, query_blocks = max(1, -(-n // BLOCK)), max(1, -(-m // BLOCK))
    spread = lambda blocks: F.pmod(F.xxhash64(F.lit(3), "row"), F.lit(blocks)).cast("int")
    everyone = index.withColumn("rb", spread(row_blocks)).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    asked = queries.withColumn("qb", spread(query_blocks)).withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))
    found = everyone.groupBy("rb", "qb").cogroup(asked.groupBy("rb", "qb")).applyInArrow(
        _search(k), "query_row long, query_id long, vec_id long, score long")
    place = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r, [CAST(floor(64 * CAST(c AS DOUBLE)) AS DOUBLE) for c in embedding] AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([c for c in embedding if c IS NULL OR NOT isfinite(c)]) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.r <> c.r)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20"""
