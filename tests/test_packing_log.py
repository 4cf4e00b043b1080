"""Small log files are packed across commits; readers, retries and expiry see no change."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from strata.sources.table import PACK, KeyedTable
from strata.spec import TableSpec
from tests.test_durability import T, batch, snap, table

LONG = dict(table_type="mor", compact_every=1000, keep_commits=1000)


def rows_of(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def files(root):
    return [f for f in glob.glob(f"{root}/**/*.parquet", recursive=True)]


def test_fifty_small_commits_end_in_files_of_the_floor(spark, tmp_root):
    floor = 6_000
    t = table(spark, tmp_root, small_file_bytes=floor, pack_every=10, keep_versions=1, **LONG)
    feed = spark.range(0, 5000).select(F.col("id").alias("k"), F.lit("p").alias("p"), F.lit(T[0]).cast("timestamp_ntz").alias("ts"),
                                       F.sha2(F.col("id").cast("string"), 256).alias("v"))
    for c in range(50):
        t.write(feed.where((F.col("k") % 50 == c) & (F.col("k") < 500)))
    t.pack()
    t.write(batch(spark, [(9999, "p", T[0], "last")]))
    t.write(batch(spark, [(9998, "p", T[0], "last")]))
    loose, packs = t._placed(t.log_commits())
    assert packs[0][0] == 0 and packs[-1][1] == 49 and loose == [50, 51]
    packed = files(t.pack_dir)
    sizes = sorted(os.path.getsize(f) for f in packed)
    # what packs replaced is gone, and at most the newest pack is below the floor
    assert len(packed) == len(packs) < 25 and all(s >= floor for s in sizes[1:])
    assert sorted(int(os.path.basename(x).split("=")[1]) for x in glob.glob(f"{t.log_dir}/commit=*")) == loose
    want = feed.where("k < 500").withColumn("commit", F.col("k") % 50)
    assert rows_of(t.snapshot().where("k < 9000")) == rows_of(want)
    assert rows_of(t.increment(17, 41)) == rows_of(want.where("commit > 17 and commit <= 41"))
    assert rows_of(t.snapshot(as_of=23)) == rows_of(want.where("commit <= 23"))


@pytest.mark.parametrize("ordering", ["arrival", "event_time"])
def test_all_methods_and_partitions_read_alike_from_packs(spark, tmp_root, ordering):
    def run(name, pack_every):
        t = KeyedTable(spark, TableSpec(name=name, path=f"{tmp_root}/{name}", keys="k", precombine="ts", partition_by="p", ordering=ordering,
                                        pack_every=pack_every, **LONG))
        t.write(batch(spark, [(1, "a", T[0], "x"), (2, None, T[0], "y"), (3, "b", T[5], "z")]), tag="w#0")
        t.write(batch(spark, [(1, "b", T[1], "moved"), (4, "", T[1], "empty")]), tag="w#1")
        t.write(batch(spark, [(3, "b", T[6], None)]).select("k", "p", "ts"), "delete", tag="w#2")
        t.write(batch(spark, [(5, "a", T[2], "one"), (5, "a", T[2], "one")]), "bulk_insert", tag="w#3")
        t.write(batch(spark, [(3, "c", T[3], "late"), (6, "a", T[7], None)]).withColumn("extra", F.lit(7)), tag="w#4")
        t.write(batch(spark, [(7, "b", T[4], "q")]), "insert_overwrite", tag="w#5")
        return t

    plain, packed = run("plain", 1000), run("packed", 2)
    assert plain.packs() == [] and packed.packs()
    packed.pack()
    assert packed.commits() == plain.commits()
    assert rows_of(packed.snapshot()) == rows_of(plain.snapshot())
    for since in range(-1, 6):
        assert rows_of(packed.increment(since, with_deletes=True)) == rows_of(plain.increment(since, with_deletes=True))
    assert packed.write(batch(spark, [(1, "z", T[9], "again")]), tag="w#3") == 3  # a retry finds its commit
    assert rows_of(packed.log()) == rows_of(plain.log())


def test_expiry_inside_a_pack(spark, tmp_root):
    t = table(spark, tmp_root, pack_every=3, **LONG)
    for i in range(6):
        t.write(batch(spark, [(i, "p", T[i], str(i))]))
    assert t.packs() == [(0, 5)] or t.packs()[-1][1] == 5
    t.compact()
    t.expire_log(3)
    assert t.log_commits() == [4, 5] and sorted(r["k"] for r in t.increment(3).collect()) == [4, 5]
    with pytest.raises(ValueError, match="expired"):
        t.increment(2)
    for i in range(6, 9):
        t.write(batch(spark, [(i, "p", T[i], str(i))]))
    t.pack()
    assert sorted(r["k"] for r in t.increment(3).collect()) == [4, 5, 6, 7, 8] and len(snap(t)) == 9
    t.compact()
    t.expire_log(8)
    assert t._all_packs() == {} and files(t.pack_dir) == [] and len(snap(t)) == 9


def test_an_unfinished_pack_is_not_read_and_made_again(spark, tmp_root):
    t = table(spark, tmp_root, pack_every=100, **LONG)
    for i in range(3):
        t.write(batch(spark, [(i, "p", T[i], str(i))]))
    t.log().write.parquet(f"{t.pack_dir}/{PACK}=c0-2")  # no marker
    assert t.packs() == [] and len(snap(t)) == 3
    assert t.pack() == 1 and t.packs() == [(0, 2)]
    assert len(snap(t)) == 3 and t.log().count() == 3 and t.pack() == 0


def test_a_pack_is_pruned_by_its_commits(spark, tmp_root):
    t = table(spark, tmp_root, pack_every=100, **LONG)
    for i in range(4):
        t.write(batch(spark, [(i, "p", T[i], str(i))]))
    t.pack()
    plan = t.log(since=1)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(commit,2)" in plan or "GreaterThan(commit,1)" in plan
    stats = {r["column"]: (int(r["num_rows"]), r["min"], r["max"]) for r in t.column_stats(["k", "commit"]).collect()}
    assert stats == {"k": (4, "0", "3"), "commit": (4, "0", "3")}
