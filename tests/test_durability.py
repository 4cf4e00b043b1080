"""Losses that must not happen: expiry, resets, retries, unfinished commits, type and catalog drift."""

import datetime as dt
import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strata.operators import merge
from strata.plans.chain import CUSTOMERS_SCHEMA, ORDERS_SCHEMA
from strata.plans.gold import gold_spec, run_gold
from strata.sources.raw import write_landing
from strata.sources.table import KeyedTable
from strata.spec import TableSpec
from strata.streaming.ingest import run_gold_stream, run_silver
from strata.streaming.progress import Progress

T = [dt.datetime(2024, 1, d) for d in range(1, 20)]
S = "k long, p string, ts timestamp_ntz, v string"


def batch(spark, rows):
    return spark.createDataFrame(rows, S)


def table(spark, root, **kw):
    spec = dict(name="t", path=f"{root}/t", keys="k", precombine="ts")
    spec.update(kw)
    return KeyedTable(spark, TableSpec(**spec))


def snap(t):
    return sorted((r["k"], r["p"], r["v"]) for r in t.snapshot().collect())


def order(spark, i, c, ts=1):
    return spark.createDataFrame([(str(i), str(c), f"2024-01-{ts:02d}", "1", "LOW")], ORDERS_SCHEMA)


def customer(spark, i):
    return spark.createDataFrame([(str(i), f"n{i}", "S", "C", "e", "2024-01-01")], CUSTOMERS_SCHEMA)


def tables(spark, root):
    orders = KeyedTable(spark, TableSpec(name="orders", path=f"{root}/o", keys="orderid", precombine="ts", table_type="mor"))
    customers = KeyedTable(spark, TableSpec(name="customers", path=f"{root}/c", keys="customer_id", precombine="ts"))
    return orders, customers, KeyedTable(spark, gold_spec(f"{root}/g"))


def gold_ids(gold):
    return sorted(r["orderid"] for r in gold.snapshot().collect())


def test_first_gold_reads_after_expiry(spark, tmp_root):
    orders, customers, gold = tables(spark, tmp_root)
    for i in (1, 2, 3):
        orders.write(order(spark, i, 1))
    orders.compact()
    orders.expire_log(2)
    customers.write(customer(spark, 1))
    run_gold(spark, orders, customers, gold, f"{tmp_root}/p")
    assert gold_ids(gold) == ["1", "2", "3"]
    other = KeyedTable(spark, gold_spec(f"{tmp_root}/g2"))
    run_gold_stream(spark, orders, customers, other, f"{tmp_root}/ck")
    assert gold_ids(other) == ["1", "2", "3"]


def test_reset_of_progress_and_of_a_checkpoint(spark, tmp_root):
    orders, customers, gold = tables(spark, tmp_root)
    orders.write(order(spark, 1, 1))
    customers.write(customer(spark, 1))
    first = run_gold(spark, orders, customers, gold, f"{tmp_root}/p")
    Progress(spark, f"{tmp_root}/p", "gold_orders").reset()
    again = run_gold(spark, orders, customers, gold, f"{tmp_root}/p")
    assert again.commit == first.commit + 1
    silver = KeyedTable(spark, TableSpec(name="s", path=f"{tmp_root}/s", keys="orderid", precombine="ts"))
    write_landing(order(spark, 1, 1), f"{tmp_root}/raw/a")
    run_silver(spark, f"{tmp_root}/raw", silver, ORDERS_SCHEMA, f"{tmp_root}/ck")
    os.rename(f"{tmp_root}/ck", f"{tmp_root}/ck-old")  # a fresh checkpoint at the same path
    write_landing(order(spark, 2, 1), f"{tmp_root}/raw/b")
    run_silver(spark, f"{tmp_root}/raw", silver, ORDERS_SCHEMA, f"{tmp_root}/ck")
    assert sorted(r["orderid"] for r in silver.snapshot().collect()) == ["1", "2"]


def test_corrupt_lines_are_kept_by_default(spark, tmp_root):
    silver = KeyedTable(spark, TableSpec(name="s", path=f"{tmp_root}/s", keys="orderid", precombine="ts"))
    write_landing(order(spark, 1, 1), f"{tmp_root}/raw/a")
    spark.createDataFrame([("not json",)], "value string").write.text(f"{tmp_root}/raw/b")
    run_silver(spark, f"{tmp_root}/raw", silver, ORDERS_SCHEMA, f"{tmp_root}/ck")
    held = spark.read.option("recursiveFileLookup", "true").json(f"{silver.root}/_quarantine").collect()
    assert [r["line"] for r in held] == ["not json"] and silver.snapshot().count() == 1


def test_failure_between_base_and_marker_keeps_the_table(spark, tmp_root, monkeypatch):
    t = table(spark, tmp_root, keep_versions=1)
    t.write(batch(spark, [(1, "P", T[0], "a"), (2, "P", T[0], "b")]))
    t.expire_log(0)
    before = snap(t)

    def fail(*_):
        raise OSError("lost")

    monkeypatch.setattr(KeyedTable, "_mark", fail)
    with pytest.raises(OSError):
        t.write(batch(spark, [(1, "P", T[1], "a2")]))
    monkeypatch.undo()
    assert snap(t) == before
    t.write(batch(spark, [(1, "P", T[1], "a2")]))
    assert snap(t) == [(1, "P", "a2"), (2, "P", "b")]


def test_tags_survive_other_commits(spark, tmp_root):
    t = table(spark, tmp_root, keep_commits=1)
    t.write(batch(spark, [(1, "P", T[0], "a")]), "bulk_insert", tag="s#0")
    t.cluster(["v"])
    for i in range(4):
        t.write(batch(spark, [(10 + i, "P", T[1], "x")]), tag=f"other#{i}")
    assert 0 not in t.commits()  # its marker was removed with the log
    assert t.write(batch(spark, [(1, "P", T[0], "a")]), "bulk_insert", tag="s#0") == 0
    assert len([r for r in snap(t) if r[0] == 1]) == 1


def test_increment_keeps_inserted_duplicates(spark, tmp_root):
    t = table(spark, tmp_root, table_type="mor")
    t.write(batch(spark, [(9, "P", T[0], "z")]))
    t.write(batch(spark, [(1, "P", T[0], "a"), (1, "P", T[0], "a")]), "bulk_insert")
    assert t.increment(0).count() == 2 and t.snapshot().count() == 3


def test_event_time_increment_without_its_history_raises(spark, tmp_root):
    t = table(spark, tmp_root, table_type="mor", ordering="event_time", compact_every=100, keep_versions=1)
    for i in range(3):
        t.write(batch(spark, [(1, "P", T[5 - i], str(i))]))
    t.compact()
    t.expire_log(0)
    with pytest.raises(ValueError):
        t.increment(0, until=1)
    assert t.increment(0, until=2).count() == 0  # the winner is in commit 0


def test_reserved_columns_and_types(spark, tmp_root):
    t = table(spark, tmp_root)
    with pytest.raises(ValueError, match="reserved"):
        t.write(batch(spark, [(1, "P", T[0], "a")]).withColumn("commit", F.lit(5)))
    t.write(spark.createDataFrame([(1, 1)], "k long, ts int"))
    with pytest.raises(ValueError, match="ts"):
        t.write(spark.createDataFrame([(1, "x")], "k long, ts string"))
    t.write(spark.createDataFrame([(2, 3)], "k int, ts int"))  # a lossless widening
    assert t.snapshot().count() == 2 and dict(t.snapshot().dtypes)["k"] == "bigint"


def test_gold_stream_ignores_unfinished_commits_and_late_customers(spark, tmp_root):
    orders, customers, gold = tables(spark, tmp_root)
    customers.write(customer(spark, 1))
    orders.write(order(spark, 1, 1))
    order(spark, 99, 1).write.parquet(f"{orders.log_dir}/commit=1")  # no marker
    run_gold_stream(spark, orders, customers, gold, f"{tmp_root}/ck")
    assert gold_ids(gold) == ["1"]
    orders.write(order(spark, 2, 7))
    run_gold_stream(spark, orders, customers, gold, f"{tmp_root}/ck")
    customers.write(customer(spark, 7))  # arrives alone
    run_gold_stream(spark, orders, customers, gold, f"{tmp_root}/ck")
    assert gold_ids(gold) == ["1", "2"]


def test_deletes_reach_gold(spark, tmp_root):
    orders, customers, gold = tables(spark, tmp_root)
    customers.write(customer(spark, 1))
    orders.write(order(spark, 1, 1).unionByName(order(spark, 2, 1)).unionByName(order(spark, 3, 8)))
    run_gold(spark, orders, customers, gold, f"{tmp_root}/p")
    orders.write(spark.createDataFrame([("2",), ("3",)], "orderid string"), "delete")
    customers.write(customer(spark, 8))
    run_gold(spark, orders, customers, gold, f"{tmp_root}/p")
    assert gold_ids(gold) == ["1"]


def test_log_stays_bounded_and_waits_for_readers(spark, tmp_root):
    t = table(spark, tmp_root, table_type="mor", compact_every=5, keep_commits=5, keep_versions=2)
    t.write(batch(spark, [(0, "P", T[0], "0")]))
    t.passed("reader", 0)
    for i in range(1, 16):
        t.write(batch(spark, [(i % 4, "P", T[0], str(i))]))
    assert len(t.log_commits()) == 15 and len(t.base_versions()) <= 2  # held for the reader
    t.passed("reader", 15)
    for i in range(16, 24):
        t.write(batch(spark, [(i % 4, "P", T[0], str(i))]))
    assert len(t.commits()) <= 13 and len(glob.glob(f"{t.log_dir}/commit=*")) == len(t.log_commits())
    assert snap(t) == [(k, "P", str(20 + k)) for k in range(4)]
    with pytest.raises(ValueError):
        t.increment(0)


def test_untouched_buckets_keep_their_files(spark, tmp_root):
    t = table(spark, tmp_root, buckets=8, keep_versions=1)
    t.write(batch(spark, [(i, "P", T[0], "a") for i in range(200)]))
    old = {f: os.path.getmtime(f) for f in glob.glob(f"{t.base_dir}/**/*.parquet", recursive=True)}
    t.write(batch(spark, [(7, "P", T[1], "b")]))
    new = {f: os.path.getmtime(f) for f in glob.glob(f"{t.base_dir}/**/*.parquet", recursive=True)}
    assert len(set(old) - set(new)) == 1 and len(set(new) - set(old)) == 1
    assert all(old[f] == new[f] for f in set(old) & set(new))
    assert dict((k, v) for k, _, v in snap(t))[7] == "b" and len(snap(t)) == 200


def test_append_only_methods_on_merge_on_read(spark, tmp_root):
    t = table(spark, tmp_root, table_type="mor", partition_by="p")
    t.write(batch(spark, [(i, "PQ"[i % 2], T[0], "a") for i in range(20)]))
    t.write(batch(spark, [(50, "P", T[1], "i")]), "bulk_insert")
    t.write(spark.createDataFrame([(1,), (50,)], "k long"), "delete")
    t.write(batch(spark, [(60, "P", T[1], "o")]), "insert_overwrite")
    t.write(batch(spark, [(3, "Q", T[1], "u"), (3, "Q", T[0], "late")]))
    t.write(batch(spark, [(3, "Q", T[2], "no"), (61, "Q", T[2], "yes")]), "insert_if_absent")
    assert not os.path.exists(t.base_dir)  # nothing was rewritten
    want = sorted([(i, "Q", "u" if i == 3 else "a") for i in range(3, 20, 2)] + [(60, "P", "o"), (61, "Q", "yes")])
    assert snap(t) == want
    c = table(spark, f"{tmp_root}/cow", partition_by="p")
    for m, rows in (("upsert", [(i, "PQ"[i % 2], T[0], "a") for i in range(20)]), ("bulk_insert", [(50, "P", T[1], "i")])):
        c.write(batch(spark, rows), m)
    c.write(spark.createDataFrame([(1,), (50,)], "k long"), "delete")
    c.write(batch(spark, [(60, "P", T[1], "o")]), "insert_overwrite")
    c.write(batch(spark, [(3, "Q", T[1], "u")]))
    c.write(batch(spark, [(3, "Q", T[2], "no"), (61, "Q", T[2], "yes")]), "insert_if_absent")
    assert snap(c) == want


def test_catalog_follows_moved_rows_and_new_columns(spark, tmp_root):
    t = table(spark, tmp_root, partition_by="p")
    t.write(batch(spark, [(1, "P", T[0], "a"), (2, "it's", T[0], "b")]))
    name = t.register("strata_test_db.moves")
    t.write(batch(spark, [(1, "Q", T[1], "a")]).withColumn("extra", F.lit(1)))
    t.register(name)
    rows = spark.table(name).select("k", "p", "extra").collect()
    assert sorted(map(tuple, rows)) == [(1, "Q", 1), (2, "it's", None)]


def test_clustered_files_are_sorted_and_capped(spark, tmp_root):
    rows = spark.range(20_000).select(F.col("id").alias("k"), F.concat(F.lit("p"), F.col("id") % 3).alias("p"),
                                      F.lit(T[0]).cast("timestamp_ntz").alias("ts"), F.sha2(F.col("id").cast("string"), 512).alias("v"))
    t = table(spark, tmp_root, partition_by="p", max_file_bytes=200_000, buckets=2, compression="uncompressed")
    t.write(rows)
    t.cluster(["v"], target_bytes=400_000)
    files = glob.glob(f"{t.base_dir}/_v=1/**/*.parquet", recursive=True)
    assert len(files) > 6
    for f in files:
        v = pq.ParquetFile(f).read(columns=["v"])["v"].to_pylist()
        assert v == sorted(v) and os.path.getsize(f) < 1.3 * 200_000


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation ")


def test_fold_plans_scan_once(spark, tmp_root):
    path = f"{tmp_root}/log"
    batch(spark, [(1, "P", T[0], "a")]).withColumn("commit", F.lit(0).cast("bigint")).write.parquet(path)
    log = spark.read.parquet(path)
    for ordering in ("arrival", "event_time"):
        assert scans(merge.fold_log(log, "k", "ts", ordering)) == 1
        for n in (2, 8):
            assert scans(merge.fold_batches([log] * n, "k", "ts", ordering)) == n
    merged = merge.upsert(log, batch(spark, [(1, "P", T[1], "b")]), "k", "ts", "event_time")
    assert scans(merged) == 1
    assert [(r["v"]) for r in merged.collect()] == ["b"]


def test_hot_batch_key_is_aggregated_before_the_join(spark, tmp_root):
    base = spark.range(1000).select(F.col("id").alias("k"), F.lit("b").alias("v"))
    hot = spark.range(5000).select(F.lit(7).cast("long").alias("k"), F.lit("h").alias("v"))
    plan = merge.delete_keys(base, hot, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from strata import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        session.checkpoint_root(Session())
