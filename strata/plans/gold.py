"""Gold job: changed orders since the last run, joined with current customers, upserted into
``gold_orders`` keyed on (orderid, customer_id).

Per run (one consumer, progress keyed by consumer and source):
  1. since = last processed orders commit (none on the first run); upto = last commit
  2. todo  = orders increment (since, upto] (first run: the snapshot, complete even where old
             log commits are gone)  ∪  orders left pending by the previous run
             [∪ orders of customers that changed, when ``refresh_dim``]
  3. gold rows = todo ⋈ customer snapshot (the SQL, or any user SQL over views
     ``orders`` / ``customers``) -> keyed upsert into gold, tagged with the run number
  4. todo rows without a customer are kept as ``pending/run=<k>`` for the next run
  5. retraction: the stored gold rows of the orders in ``todo`` are their image before the run; those
     that the join does not give again (the order moved to another customer, was deleted, lost its
     customer or no longer passes the SQL) go in the same gold commit.  Orders of customers deleted
     since the last run are in ``todo`` too: they wait in pending until the customer returns.
  6. progress is written last; a rerun after a failure repeats the same run idempotently
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators import merge
from strata.operators.join import GOLD_KEYS, GOLD_SQL, split_join, touched_by, unmatched
from strata.sources.table import MERGE, KeyedTable
from strata.spec import COMMIT, DELETED, TableSpec
from strata.streaming.progress import Progress


def gold_spec(path: str, **kw) -> TableSpec:
    """gold_orders: key (orderid, customer_id), latest order_ts wins (deterministic tiebreak)."""
    base = dict(name="gold_orders", path=path, keys=GOLD_KEYS, precombine="order_ts", table_type="cow")
    base.update(kw)
    return TableSpec(**base)


@dataclass
class GoldRun:
    run: int
    since: int | None
    upto: int | None
    commit: int | None


def _pending_path(progress: Progress, run: int) -> str:
    return f"{progress.dir}/pending/run={run}"


def run_gold(spark: SparkSession, orders: KeyedTable, customers: KeyedTable, gold: KeyedTable,
             progress_root: str, consumer: str = "gold_orders", refresh_dim: bool = False,
             sql: str = GOLD_SQL) -> GoldRun:
    progress = Progress(spark, progress_root, consumer)
    o_src, c_src = orders.spec.name, customers.spec.name
    upto = orders.last_commit()
    c_upto = customers.last_commit()
    since = progress.last_processed(o_src)
    c_since = progress.last_processed(c_src)
    run = progress.next_run()
    prev = run - 1 if run > 0 else None
    if upto is None or c_upto is None:
        return GoldRun(run, since, upto, None)
    cust_changed = c_since is not None and c_upto > c_since
    dim_changed = refresh_dim and cust_changed
    dim_removed = cust_changed and _removes(customers, c_since, c_upto)
    fresh = since is None or upto > since
    if not fresh and not (cust_changed and (refresh_dim or dim_removed or _has_pending(progress, prev))):
        # nothing new: no increment, no customer arrived for a pending order, none left
        return GoldRun(run, since, upto, None)

    gone = None
    if since is None:
        todo = orders.snapshot()
    elif fresh:
        todo = orders.increment(since, until=upto)
        if _removes(orders, since, upto):
            gone = orders.increment(since, until=upto, with_deletes=True).where(DELETED).select(*orders.spec.keys)
    else:
        todo = orders.snapshot().limit(0)
    pend = _read_pending(spark, orders, progress, prev)
    if pend is not None:
        # an order still pending may have a newer version in this increment: newest wins
        todo = merge.upsert(pend, todo, orders.spec.merge_keys, orders.spec.precombine, "arrival")
        if gone is not None:
            todo = merge.delete_keys(todo, gone, orders.spec.keys)
    cust = customers.snapshot()
    if dim_changed or dim_removed:
        again = orders.snapshot()
        gone_log = customers.expired_before()
        if gone_log is None or c_since >= gone_log:  # else: which customers changed is not known any more
            changed = customers.increment(c_since, until=c_upto, with_deletes=True)
            again = touched_by(again, changed if dim_changed else changed.where(DELETED))
        todo = merge.upsert(again, todo, orders.spec.merge_keys, orders.spec.precombine, "arrival")

    todo = todo.drop(COMMIT)
    cust = cust.drop(COMMIT)
    # a rerun of the same range finds its gold commit; a wider range or a reset is a new one
    tag = f"{progress.dir}#{progress.generation()}:{run}:{since}:{upto}:{c_upto}"
    if sql is GOLD_SQL:
        # one left join serves both outputs: the customers side is exchanged once per run
        rows, waiting, held = split_join(todo, cust)
    else:
        held = todo
    held = held.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if sql is not GOLD_SQL:
            held.createOrReplaceTempView("orders")
            cust.createOrReplaceTempView("customers")
            rows, waiting = held.sparkSession.sql(sql), unmatched(held, cust)
        doomed = _stale(gold, held, gone, orders.spec.keys) if since is not None or gold.exists() else None
        commit = gold.write(rows, "upsert", tag=tag, cached=sql is GOLD_SQL, doomed=doomed)
        waiting.write.mode("overwrite").parquet(_pending_path(progress, run))
    finally:
        held.unpersist()
    # fixed values: the keys of a progress entry
    progress.write({
        o_src: {"table_name": o_src, "path": orders.root, "last_processed_commit": upto if since is None else max(upto, since)},
        c_src: {"table_name": c_src, "path": customers.root, "last_processed_commit": c_upto},
    })
    orders.passed(progress.dir, upto if since is None else max(upto, since))
    customers.passed(progress.dir, c_upto)
    if prev is not None:
        # the previous run's pending rows are superseded once this run's progress is durable
        progress.fs.delete(_pending_path(progress, prev))
    return GoldRun(run, since, upto, commit)


def _removes(table: KeyedTable, since: int | None, until: int) -> bool:
    """Whether commits in (since, until] may have removed keys (or are not known any more)."""
    expired = table.expired_before()
    if since is not None and expired is not None and since < expired:
        return True
    return bool({"delete", MERGE} & set(table.log_methods(since, until).values()))


def _stale(gold: KeyedTable, todo: DataFrame, gone: DataFrame | None, keys) -> DataFrame | None:
    """Keys of the stored gold rows of the orders that this run decides anew."""
    if any(k not in gold.spec.merge_keys for k in keys) or not gold.exists():
        return None
    decided = todo.select(*keys)
    if gone is not None:
        decided = decided.unionByName(gone)
    return merge.semi_join_keys(gold.snapshot().select(*gold.spec.merge_keys), decided, keys, "left_semi")


def _has_pending(progress: Progress, run: int | None) -> bool:
    if run is None:
        return False
    return progress.fs.exists(f"{_pending_path(progress, run)}/_SUCCESS")


def _read_pending(spark: SparkSession, orders: KeyedTable, progress: Progress, run: int | None) -> DataFrame | None:
    """Orders left without a customer by run ``run`` (stamped with commit -1: older than any)."""
    if not _has_pending(progress, run):
        return None
    schema = orders.schema()
    cols = [f for f in schema.fields if f.name not in (COMMIT, "_is_deleted")]
    return spark.read.schema(StructType(cols)).parquet(_pending_path(progress, run)).withColumn(
        COMMIT, F.lit(-1).cast("bigint"))


def pending_orders(spark: SparkSession, progress_root: str, consumer: str, orders: KeyedTable) -> DataFrame:
    """Orders waiting for their customer after the consumer's last run."""
    progress = Progress(spark, progress_root, consumer)
    doc = progress.read()
    pend = _read_pending(spark, orders, progress, doc["run"] if doc else None)
    return pend.drop(COMMIT) if pend is not None else orders.snapshot().drop(COMMIT).limit(0)
