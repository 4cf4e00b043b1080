"""Keyed write semantics as pure DataFrame -> DataFrame functions.

Nothing here reads or writes storage; the table layer and every job call these, so the
queries that check them run exactly the code the jobs run.

Scale notes
  * "latest row per key" is ``row_number() = 1`` over a window.  Catalyst turns the
    ``= 1`` filter into a WindowGroupLimit that runs *before* the shuffle as well, so a key
    that holds a third of the rows is cut to one row per map task before it is exchanged.
  * an upsert never shuffles the stored rows against themselves: only keys present in the
    batch can change, so stored rows meet the batch's distinct keys in an anti join (arrival)
    or its winners in one full outer join (event_time).  The key side is small in the normal
    case and Catalyst / AQE broadcast it when its measured size is under
    ``autoBroadcastJoinThreshold``; otherwise it is a sort-merge join with AQE skew splitting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.scalar import key_list
from strata.spec import COMMIT, DELETED, METHODS

def _comparable(name: str, dtype: str) -> Column:
    """The column, or a text of it where its type has no order (maps, variants): a map's entries
    sorted by key, so that equal maps compare equal."""
    if dtype.startswith("map<") and dtype.count("map<") == 1 and "variant" not in dtype:
        return F.to_json(F.array_sort(F.map_entries(F.col(name))))
    if "map<" in dtype or "variant" in dtype:
        return F.to_json(F.struct(F.col(name)))
    return F.col(name)


def tiebreak(df: DataFrame, skip: Sequence[str] = ()) -> list[Column]:
    """Deterministic tiebreak: remaining columns, descending, NULLs last, in schema order."""
    skip = set(skip)
    return [_comparable(c, t).desc_nulls_last() for c, t in df.dtypes if c not in skip]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key under ``order``."""
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def _order(df: DataFrame, keys, precombine, leading: Sequence[str] = (), trailing: Sequence[str] = ()):
    order = [F.col(c).desc_nulls_last() for c in leading]
    if precombine:
        order.append(F.col(precombine).desc_nulls_last())
    order += [F.col(c).desc_nulls_last() for c in trailing]
    used = [*keys, *leading, *trailing] + ([precombine] if precombine else [])
    return order + tiebreak(df, used)


def precombine(df: DataFrame, keys, precombine: str | None = None) -> DataFrame:
    """One row per key inside one batch: greatest precombine value wins (NULL loses), then
    the full-row tiebreak.  Rows stamped with different commits: the newest commit first."""
    keys = key_list(keys)
    leading = [COMMIT] if COMMIT in df.columns else []
    return latest_per_key(df, keys, _order(df, keys, precombine, leading=leading))


def snapshot_order(df: DataFrame, keys, precombine, ordering: str) -> list[Column]:
    """Order that puts the current version of a key first."""
    keys = key_list(keys)
    has_commit = COMMIT in df.columns
    if ordering == "arrival":
        return _order(df, keys, precombine, leading=[COMMIT] if has_commit else [])
    return _order(df, keys, precombine, trailing=[COMMIT] if has_commit else [])


def _key_frame(batch: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """Distinct batch keys renamed apart, and the null-safe match condition against them.

    Distinct aggregates before its exchange, so a key that holds a third of the batch reaches
    the join once and not as one unsplittable reducer."""
    renamed = [f"__key_{i}" for i in range(len(keys))]
    kf = batch.select(*[F.col(k).alias(r) for k, r in zip(keys, renamed)]).distinct()
    cond = None
    for k, r in zip(keys, renamed):
        c = F.col(k).eqNullSafe(F.col(r))
        cond = c if cond is None else cond & c
    return kf, cond


def semi_join_keys(df: DataFrame, batch: DataFrame, keys, how: str) -> DataFrame:
    """Rows of ``df`` whose key is (left_semi) / is not (left_anti) in ``batch``; NULL keys match."""
    keys = key_list(keys)
    kf, cond = _key_frame(batch, keys)
    return df.join(kf, cond, how)


def upsert(base: DataFrame | None, batch: DataFrame, keys, precombine: str | None = None,
           ordering: str = "arrival", unique: bool = True, settled: bool = False) -> DataFrame:
    """Keyed upsert: a key present in the batch is replaced, other stored rows are kept.

    arrival     the batch (after precombine) wins over stored rows
    event_time  the greatest precombine value wins, stored rows included (late rows lose)

    ``unique``: every stored key has one row.  Otherwise (rows were appended without looking at
    keys) an event-time upsert leaves one row of each key that it brings.  ``settled``: the batch
    has one row per key already.
    """
    keys = key_list(keys)
    if ordering not in ("arrival", "event_time"):
        raise ValueError(f"unknown ordering {ordering!r}")
    winners = batch if settled else latest_per_key(batch, keys, snapshot_order(batch, keys, precombine, ordering))
    if base is None:
        return winners
    if ordering == "arrival":
        kept = semi_join_keys(base, batch, keys, "left_anti")
        return kept.unionByName(winners, allowMissingColumns=True)
    if not unique:
        met = semi_join_keys(base, winners, keys, "left_semi").unionByName(winners, allowMissingColumns=True)
        return semi_join_keys(base, winners, keys, "left_anti").unionByName(
            latest_per_key(met, keys, snapshot_order(met, keys, precombine, ordering)), allowMissingColumns=True)
    return _greater_of(base, winners, keys, precombine)


def _greater_of(base: DataFrame, winners: DataFrame, keys: Sequence[str], precombine_col: str | None) -> DataFrame:
    """event_time upsert in one pass over the stored rows: one full outer join on the key, and of
    the two rows that meet the greater one by (precombine, commit, remaining columns)."""
    types = dict(base.dtypes) | {c: t for c, t in winners.dtypes if c not in base.columns}
    columns = list(types)
    lead = [c for c in (precombine_col, COMMIT) if c and c in columns]
    rank = [F.col(c) for c in lead] + [_comparable(c, types[c]).alias(c) for c in columns if c not in lead and c not in keys]

    def side(df: DataFrame, name: str) -> DataFrame:
        full = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(types[c]).alias(c) for c in columns])
        return full.select(*[F.col(k).alias(f"__{name}{i}") for i, k in enumerate(keys)],
                           F.struct(*rank).alias(f"__{name}_rank"),
                           F.struct(*[F.col(c) for c in columns]).alias(f"__{name}"))

    cond = None
    for i in range(len(keys)):
        c = F.col(f"__old{i}").eqNullSafe(F.col(f"__new{i}"))
        cond = c if cond is None else cond & c
    met = side(base, "old").join(side(winners, "new"), cond, "full_outer")
    row = (F.when(F.col("__old").isNull(), F.col("__new")).when(F.col("__new").isNull(), F.col("__old"))
           .when(F.col("__old_rank") > F.col("__new_rank"), F.col("__old")).otherwise(F.col("__new")))
    return met.select(row.alias("__row")).select("__row.*")


def insert_if_absent(base: DataFrame, batch: DataFrame, keys, precombine_col: str | None = None) -> DataFrame:
    """Stored rows never change; batch rows are added only for keys not stored yet."""
    keys = key_list(keys)
    fresh = semi_join_keys(precombine(batch, keys, precombine_col), base, keys, "left_anti")
    return base.unionByName(fresh, allowMissingColumns=True)


def delete_keys(base: DataFrame, doomed: DataFrame, keys) -> DataFrame:
    """Drop every stored row whose key appears in ``doomed``."""
    return semi_join_keys(base, doomed, keys, "left_anti")


def insert_overwrite(base: DataFrame, batch: DataFrame, partition_by) -> DataFrame:
    """Partitions present in the batch are replaced by the batch rows; others are kept."""
    parts = key_list(partition_by)
    if not parts:
        return batch
    touched = batch.select(*parts).distinct()
    kept = semi_join_keys(base, touched, parts, "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def bulk_insert(base: DataFrame | None, batch: DataFrame) -> DataFrame:
    """Append without looking at keys: duplicates are kept."""
    return batch if base is None else base.unionByName(batch, allowMissingColumns=True)


def tombstones(batch: DataFrame, keys, time: str | None = None) -> DataFrame:
    """Key-only rows marking deletion in a log; with ``time``, each at the greatest time of its key."""
    keys = key_list(keys)
    if time is None or time in keys:
        marked = batch.select(*keys).distinct()
    else:
        marked = batch.groupBy(*keys).agg(F.max(time).alias(time))
    return marked.withColumn(DELETED, F.lit(True))


def apply_write(base: DataFrame | None, batch: DataFrame, method: str, keys, precombine_col=None,
                ordering: str = "arrival", partition_by=(), unique: bool = True, settled: bool = False) -> DataFrame:
    """The write-operation switch: the new current rows after ``method``."""
    method = (method or "upsert").lower()
    if method not in METHODS:
        raise ValueError(f"unknown write method {method!r}; expected one of {METHODS}")
    if method == "upsert":
        return upsert(base, batch, keys, precombine_col, ordering, unique, settled)
    if method in ("insert", "bulk_insert"):
        return bulk_insert(base, batch)
    if method == "insert_if_absent":
        return precombine(batch, keys, precombine_col) if base is None else insert_if_absent(base, batch, keys, precombine_col)
    if method == "insert_overwrite":
        return batch if base is None else insert_overwrite(base, batch, partition_by)
    if base is None:
        return batch.limit(0)
    return delete_keys(base, batch, keys)


def fold_log(log: DataFrame, keys, precombine_col=None, ordering="arrival") -> DataFrame:
    """All upserts of a commit-stamped log at once: one scan, one exchange.

    Upserts are associative, so the newest commit (arrival) or greatest precombine (event_time)
    of a key among *all* rows is what applying the commits one after the other leaves."""
    keys = key_list(keys)
    return latest_per_key(log, keys, snapshot_order(log, keys, precombine_col, ordering))


def fold_batches(batches: Sequence[DataFrame], keys, precombine_col=None, ordering="arrival") -> DataFrame:
    """Apply upserts batch after batch (oldest first), as one ``fold_log`` over their union."""
    stamped = COMMIT in batches[0].columns
    log = None
    for i, b in enumerate(batches):
        b = b if stamped else b.withColumn(COMMIT, F.lit(i).cast("bigint"))
        log = b if log is None else log.unionByName(b, allowMissingColumns=True)
    out = fold_log(log, keys, precombine_col, ordering)
    return out if stamped else out.drop(COMMIT)


def fold_tail(base: DataFrame | None, tail: DataFrame, methods: dict[int, str], keys, precombine_col=None,
              ordering: str = "arrival", partition_by=(), unique: bool = True) -> DataFrame:
    """Rows after the commits of a log tail of any write methods (tombstones are still in).

    A commit that upserts or deletes a key ends every older row of that key; one that overwrites
    a partition ends every older row of it; inserts end nothing.  So each row meets the newest
    commit that ended its key and its partition (aggregated before the exchange), and stored
    rows meet the same keys in one anti join.
    """
    keys, parts = key_list(keys), key_list(partition_by)
    keyed = [c for c, m in methods.items() if m in ("upsert", "delete")]
    replaced = [c for c, m in methods.items() if m == "insert_overwrite"]
    if len(keyed) == len(methods):
        return upsert(base, tail, keys, precombine_col, ordering, unique)
    if ordering != "arrival":
        raise ValueError("only upserts can be folded by event time")
    rows, old = tail, base
    for commits, by in ((keyed, keys), (replaced, parts)):
        if not commits:
            continue
        if not by:  # no partitions: the whole table was replaced
            old, rows = None, rows.where(F.col(COMMIT) >= max(commits))
            continue
        names = [f"__by_{i}" for i in range(len(by))]
        ended = (tail.where(F.col(COMMIT).isin(commits)).groupBy(*[F.col(k).alias(n) for k, n in zip(by, names)])
                 .agg(F.max(COMMIT).alias("__ended")))
        cond = None
        for k, n in zip(by, names):
            c = F.col(k).eqNullSafe(F.col(n))
            cond = c if cond is None else cond & c
        if old is not None:
            old = old.join(ended, cond, "left_anti")
        rows = rows.join(ended, cond, "left").where(F.col("__ended").isNull() | (F.col(COMMIT) >= F.col("__ended"))).drop(*names, "__ended")
    return rows if old is None else old.unionByName(rows, allowMissingColumns=True)
