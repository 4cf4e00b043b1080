"""The keyed table on disk: commits, both table types, maintenance, restarts, plans."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from strata.sources.table import KeyedTable, open_table
from strata.spec import TableSpec

T = [dt.datetime(2024, 1, d) for d in range(1, 9)]
S = "k long, p string, ts timestamp_ntz, v string"


def batch(spark, rows):
    return spark.createDataFrame(rows, S)


def table(spark, root, **kw):
    spec = dict(name="t", path=f"{root}/t", keys="k", precombine="ts")
    spec.update(kw)
    return KeyedTable(spark, TableSpec(**spec))


def snap(t):
    return sorted((r["k"], r["p"], r["v"]) for r in t.snapshot().collect())


BATCHES = [
    [(1, "P", T[0], "a"), (2, "P", T[0], "b"), (3, "Q", T[0], "c")],
    [(1, "P", T[2], "a2"), (4, "Q", T[1], "d")],
    [(2, "Q", T[3], "b-moved"), (1, "P", T[1], "a-late")],
]


@pytest.mark.parametrize("ttype", ["cow", "mor"])
@pytest.mark.parametrize("ordering", ["arrival", "event_time"])
def test_cow_equals_mor_and_orderings(spark, tmp_root, ttype, ordering):
    t = table(spark, tmp_root, table_type=ttype, ordering=ordering, partition_by="p")
    for b in BATCHES:
        t.write(batch(spark, b))
    late_winner = "a-late" if ordering == "arrival" else "a2"
    assert snap(t) == [(1, "P", late_winner), (2, "Q", "b-moved"), (3, "Q", "c"), (4, "Q", "d")]
    assert t.commits() == [0, 1, 2]
    assert (t.base_versions() != []) == (ttype == "cow")


def test_increment_and_compaction(spark, tmp_root):
    t = table(spark, tmp_root, table_type="mor")
    for b in BATCHES:
        t.write(batch(spark, b))
    inc = sorted((r["k"], r["commit"]) for r in t.increment(0).collect())
    assert inc == [(1, 2), (2, 2), (4, 1)]
    before = snap(t)
    assert t.compact() == 2 and t.base_versions() == [2]
    assert snap(t) == before
    t.write(batch(spark, [(5, "P", T[4], "e")]))
    assert snap(t) == sorted(before + [(5, "P", "e")])
    t.expire_log(2)
    with pytest.raises(ValueError):
        t.increment(0)
    assert [r["k"] for r in t.increment(2).collect()] == [5]


def test_retention_and_cluster(spark, tmp_root):
    t = table(spark, tmp_root, table_type="cow", keep_versions=2, buckets=1)
    for i in range(4):
        t.write(batch(spark, [(i, "P", T[i], str(i))]))
    assert t.base_versions() == [2, 3]
    assert not os.path.exists(f"{tmp_root}/t/base/_v=0")
    before = snap(t)
    n = t.cluster(["v"])
    assert n == 4 and snap(t) == before
    assert t.increment(3).count() == 0  # clustering adds nothing to the log


def test_empty_batch_writes_nothing(spark, tmp_root):
    t = table(spark, tmp_root)
    assert t.write(batch(spark, BATCHES[0]).limit(0)) is None
    assert t.commits() == []
    assert not os.path.exists(f"{tmp_root}/t/log")


def test_retry_with_same_tag_reuses_commit(spark, tmp_root):
    t = table(spark, tmp_root, table_type="cow")
    t.write(batch(spark, BATCHES[0]), tag="s#0")
    # a batch that failed after its data write but before its commit marker
    n, done = t._claim("s#1")
    batch(spark, BATCHES[1]).write.parquet(f"{t.log_dir}/commit={n}")
    assert t.commits() == [0] and len(snap(t)) == 3  # the half-written commit is invisible
    assert t.write(batch(spark, BATCHES[1]), tag="s#1") == n == 1
    assert t.write(batch(spark, BATCHES[1]), tag="s#1") == 1  # already committed: no-op
    assert t.commits() == [0, 1]
    assert snap(t) == [(1, "P", "a2"), (2, "P", "b"), (3, "Q", "c"), (4, "Q", "d")]


def test_methods_and_open_table(spark, tmp_root):
    t = table(spark, tmp_root, table_type="mor", partition_by="p")
    t.write(batch(spark, BATCHES[0]))
    t.write(spark.createDataFrame([(2,)], "k long"), "delete")
    assert [r[0] for r in snap(t)] == [1, 3]
    t.write(batch(spark, [(7, "P", T[5], "g")]), "insert_overwrite")
    assert snap(t) == [(3, "Q", "c"), (7, "P", "g")]
    t.write(batch(spark, [(7, "P", T[6], "g2")]), "bulk_insert")
    assert len(snap(t)) == 3
    with pytest.raises(ValueError):
        t.write(batch(spark, BATCHES[0]), "merge")
    again = open_table(spark, t.root)
    assert again.spec.keys == ("k",) and snap(again) == snap(t)


def test_sql_transformer(spark, tmp_root):
    t = table(spark, tmp_root)
    t.write(batch(spark, BATCHES[0]), sql_transformer="SELECT k, p, ts, upper(v) AS v FROM temp WHERE k > 1")
    assert snap(t) == [(2, "P", "B"), (3, "Q", "C")]


def test_catalog_and_stats(spark, tmp_root):
    t = table(spark, tmp_root, partition_by="p")
    t.write(batch(spark, BATCHES[0]))
    name = t.register("strata_test_db.t")
    assert spark.table(name).count() == 3
    t.write(batch(spark, BATCHES[1]))
    t.register("strata_test_db.t")
    assert spark.table(name).count() == 4
    stats = t.column_stats().collect()
    assert {c: sum(r["num_rows"] for r in stats if r["column"] == c) for c in ("k", "ts")} == {"k": 4, "ts": 4}


def test_plans_prune_and_pre_aggregate(spark, tmp_root):
    t = table(spark, tmp_root, table_type="mor", partition_by="p")
    for b in BATCHES:
        t.write(batch(spark, b))
    inc_plan = t.increment(1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(commit" in inc_plan and "(commit" in inc_plan
    # global key scope: a row may have left partition Q in a later commit, so the filter must
    # stay above the fold; with partition scope or a copy-on-write base it reaches the scan
    for kw in (dict(table_type="mor", scope="partition"), dict(table_type="cow")):
        u = table(spark, f"{tmp_root}/{kw['table_type']}", partition_by="p", **kw)
        for b in BATCHES:
            u.write(batch(spark, b))
        read_plan = u.snapshot().where(F.col("p") == "Q")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(p" in read_plan, kw
    snap_plan = t.snapshot()._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in snap_plan
