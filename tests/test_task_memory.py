"""What one task sorts when files are rewritten stays under a fixed size; rows and order are unchanged."""

import glob
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strata.plans.registry import _in_file_order
from strata.sources import table as table_module
from tests.test_durability import T, table
from tests.test_packing_log import rows_of


def feed(spark, n, value="id % 7"):
    return spark.range(0, n, 1, 4).select(F.col("id").alias("k"), F.concat(F.lit("p"), F.col("id") % 2).alias("p"),
                                          F.lit(T[0]).cast("timestamp_ntz").alias("ts"), F.expr(f"cast({value} as string)").alias("v"))


@pytest.mark.parametrize("value", ["id * 37 % 1000", "'same'", "null"])
def test_clustering_ranges_hold_a_fixed_size(spark, tmp_root, monkeypatch, value):
    monkeypatch.setattr(table_module, "SORT_BYTES", 100_000)
    t = table(spark, tmp_root, partition_by="p", buckets=2)
    t.write(feed(spark, 8_000, value))
    before = sorted(map(tuple, t.snapshot().collect()), key=str)
    assert t.cluster(["v"]) == 1
    tasks = Counter()  # a task's files carry its number
    for f in glob.glob(f"{t.base_dir}/_v=1/**/part-*.parquet", recursive=True):
        v = pq.ParquetFile(f).read(columns=["v"])["v"].to_pylist()
        assert v == sorted(v, key=lambda x: (x is not None, x or ""))
        tasks[f.rpartition("/part-")[2][:5]] += len(v)
    assert len(tasks) > 8 and max(tasks.values()) < 8_000 / 4
    assert sorted(map(tuple, t.snapshot().collect()), key=str) == before


def test_order_in_files_is_seen_across_blocks(spark, tmp_root):
    # the order breaks at 5, 20 and (null) 30: inside and between blocks
    values = [0, 1, 2, 3, 4, *range(2, 16), 16, *range(7, 17), None, *range(3, 8)]
    assert len(values) == 36
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v long").coalesce(1)
    rows.write.parquet(f"{tmp_root}/x/a")
    rows.withColumn("i", F.col("i") + 100).write.parquet(f"{tmp_root}/x/b")
    for block in (1, 4, 20, 36, 100):
        got = _in_file_order(spark.read.parquet(f"{tmp_root}/x/a", f"{tmp_root}/x/b"), ["v"], block)
        assert got.columns == ["i", "v", "in_order"] and got.count() == 72
        assert sorted(r["i"] for r in got.where("not in_order").collect()) == [5, 20, 30, 105, 120, 130]


def test_a_pack_is_dealt_over_tasks_of_a_fixed_size(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(table_module, "SORT_BYTES", 100_000)
    t = table(spark, tmp_root, table_type="mor", compact_every=100, keep_commits=100, pack_every=100, partition_by="p")
    for c in range(5):
        t.write(feed(spark, 2_000).withColumn("v", F.lit(f"c{c}")), "bulk_insert")
    before, since = rows_of(t.log()), rows_of(t.increment(2))
    assert t.pack() == 1 and t.packs() == [(0, 4)] and len(before) == 10_000
    files = glob.glob(f"{t.pack_dir}/**/part-*.parquet", recursive=True)
    lengths = []
    for f in files:
        commits = pq.ParquetFile(f).read(columns=["commit"])["commit"].to_pylist()
        assert commits == sorted(commits) and set(commits) == set(range(5))
        lengths.append(len(commits))
    assert len(files) > 8 and max(lengths) < 1.2 * 10_000 / len(files)
    assert rows_of(t.log()) == before and rows_of(t.increment(2)) == since
    assert t.pack() == 0


def test_packed_log_with_commits_above_the_floor(spark, tmp_root, monkeypatch):
    from strata.plans import registry

    d = f"{tmp_root}/in"
    spark.range(240).select(F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit(T[0]).cast("timestamp_ntz").alias("o_orderdate"),
                            F.lit(1.5).alias("o_totalprice"), F.lit("LOW").alias("o_orderpriority")).write.parquet(f"{d}/orders.parquet")
    plain = registry._orders_table
    monkeypatch.setattr(registry, "_orders_table", lambda *a, **k: plain(*a, small_file_bytes=1, **k))
    got = registry.packed_log(spark, d).collect()  # nothing is small: nothing to pack
    assert sorted((r["orderid"], r["commit"]) for r in got) == [(i, i % 12) for i in range(240) if i % 12 > 5]
