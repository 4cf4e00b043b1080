"""Views over a commit log: snapshot, increment, commit discovery, retention.

A *log* is any DataFrame whose rows carry the ``commit`` column (a bigint instant).  The
table layer produces it from ``log/commit=<n>/`` directories, so a ``commit`` filter here is
a partition filter there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.scalar import key_list
from strata.operators.merge import latest_per_key, semi_join_keys, snapshot_order
from strata.spec import COMMIT, DELETED


def _live(df: DataFrame) -> DataFrame:
    if DELETED in df.columns:
        return df.where(F.col(DELETED).isNull() | ~F.col(DELETED)).drop(DELETED)
    return df


def snapshot(log: DataFrame, keys, precombine=None, ordering: str = "arrival") -> DataFrame:
    """Current row of every key (deleted keys dropped)."""
    keys = key_list(keys)
    return _live(latest_per_key(log, keys, snapshot_order(log, keys, precombine, ordering)))


def increment(log: DataFrame, since: int, keys, precombine=None, ordering: str = "arrival",
              until: int | None = None, candidates: DataFrame | None = None) -> DataFrame:
    """Keys changed after instant ``since`` (exclusive) up to ``until`` (inclusive), each at its
    latest version; not every intermediate change.

    arrival     filter first (prunes commit partitions), then latest per key: the newest commit
                wins anyway, so this equals filtering the snapshot.
    event_time  a late row in a new commit may lose to an older stored one, so the winner is
                chosen among *all* versions of the changed keys and kept only if its commit is
                in range.  Only changed keys are shuffled: the log meets them through a semi join.
    ``candidates`` (event_time): rows that hold every possible winner up to ``until`` when that is
    less than the whole log, e.g. a folded base plus the log after it.
    """
    keys = key_list(keys)
    rng = F.col(COMMIT) > F.lit(since)
    if until is not None:
        rng = rng & (F.col(COMMIT) <= F.lit(until))
    if ordering == "arrival":
        changed = log.where(rng)
        return _live(latest_per_key(changed, keys, snapshot_order(changed, keys, precombine, ordering)))
    pool = log if candidates is None else candidates
    bounded = pool if until is None else pool.where(F.col(COMMIT) <= F.lit(until))
    changed_keys = log.where(rng).select(*keys)
    candidates = semi_join_keys(bounded, changed_keys, keys, "left_semi")
    winners = latest_per_key(candidates, keys, snapshot_order(candidates, keys, precombine, ordering))
    return _live(winners.where(rng))


def begin_commit(df: DataFrame) -> DataFrame:
    """``min(commit) - 1``: an exclusive bound that makes the first increment complete."""
    return df.agg((F.min(COMMIT) - F.lit(1)).alias("begin_commit"))


def last_commit(df: DataFrame) -> DataFrame:
    """Greatest commit present."""
    return df.agg(F.max(COMMIT).alias("last_commit"))


def commit_list(df: DataFrame, limit: int) -> DataFrame:
    """Distinct commits ascending, the first ``limit`` of them (a top-k)."""
    return df.select(COMMIT).distinct().orderBy(COMMIT).limit(limit)


def retain_versions(log: DataFrame, keys, keep: int = 3) -> DataFrame:
    """Rows of the latest ``keep`` commits of every key.

    Distinct (key, commit) pairs are formed first (partial aggregation before the shuffle), the
    newest ``keep`` per key picked, and the log semi-joined on (key, commit): a hot key never
    gathers its rows in one window task, and AQE can split it in the join.
    """
    keys = key_list(keys)
    pairs = log.select(*keys, COMMIT).distinct()
    w = Window.partitionBy(*keys).orderBy(F.col(COMMIT).desc())
    newest = pairs.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= keep).drop("_rn")
    return semi_join_keys(log, newest, [*keys, COMMIT], "left_semi")
