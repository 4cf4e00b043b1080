"""Deletes with a time, retractions, drifting fields, get-or-insert, old snapshots, work per bucket."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from strata.operators import merge
from strata.plans.gold import gold_spec, pending_orders, run_gold
from strata.sources.table import KeyedTable
from strata.spec import TableSpec
from strata.streaming import drift
from strata.streaming.ingest import run_silver


def table(spark, root, **kw):
    return KeyedTable(spark, TableSpec(**{**dict(name="t", path=f"{root}/t", keys="k", precombine="ts"), **kw}))


def rows(spark, *r):
    return spark.createDataFrame(list(r), "k long, p string, ts long, v string")


def live(t, **kw):
    return sorted((r.k, r.v) for r in t.snapshot(**kw).collect())


@pytest.mark.parametrize("kind", ["cow", "mor"])
@pytest.mark.parametrize("compact_every", [1, 100])
def test_timed_deletes(spark, tmp_root, kind, compact_every):
    t = table(spark, tmp_root, ordering="event_time", table_type=kind, compact_every=compact_every)
    t.write(rows(spark, (1, "P", 10, "a"), (2, "P", 10, "b"), (3, "P", 10, "c"), (4, "P", 10, "d")))
    t.write(spark.createDataFrame([(1, 20), (2, 5), (3, 10), (9, 50)], "k long, ts long"), "delete")
    assert live(t) == [(2, "b"), (4, "d")]  # an older delete loses; at equal times the newer commit wins
    gone = {(r.k, r.ts) for r in t.increment(0, with_deletes=True).where("_is_deleted").collect()}
    assert gone == {(1, 20), (3, 10), (9, 50)} and t.increment(0).count() == 0
    t.write(rows(spark, (1, "P", 15, "late"), (3, "P", 11, "new"), (9, "P", 49, "late")))
    assert live(t) == [(2, "b"), (3, "new"), (4, "d")]
    assert [r.k for r in t.increment(1).collect()] == [3]
    t.write(spark.createDataFrame([(4,), (77,)], "k long"), "delete")  # no time: that of the stored row
    t.write(rows(spark, (4, "P", 9, "late")))
    assert live(t) == [(2, "b"), (3, "new")]
    t.write(rows(spark, (4, "P", 11, "again")))
    assert live(t) == [(2, "b"), (3, "new"), (4, "again")]


def test_timed_inserts_keep_duplicates(spark, tmp_root):
    t = table(spark, tmp_root, ordering="event_time")
    t.write(rows(spark, (9, "P", 1, "z")))
    t.write(rows(spark, (1, "P", 1, "a"), (1, "P", 1, "a")), "bulk_insert")
    assert t.increment(0).count() == 2 and t.snapshot().count() == 3
    t.write(rows(spark, (1, "P", 2, "one")))
    assert live(t) == [(1, "one"), (9, "z")]  # an upsert leaves one row of its key


def test_delete_finds_partitions_or_says_why_not(spark, tmp_root):
    t = table(spark, tmp_root, partition_by="p", scope="partition")
    t.write(rows(spark, (1, "P", 1, "a"), (1, "Q", 1, "b"), (2, "Q", 1, "c")))
    t.write(spark.createDataFrame([(1,)], "k long"), "delete")
    assert live(t) == [(2, "c")]
    with pytest.raises(ValueError, match="key column"):
        t.write(spark.createDataFrame([("Q",)], "p string"), "delete")


def test_upsert_and_removal_in_one_commit(spark, tmp_root):
    for kind in ("cow", "mor"):
        t = table(spark, f"{tmp_root}/{kind}", table_type=kind)
        t.write(rows(spark, (1, "P", 1, "a"), (2, "P", 1, "b"), (3, "P", 1, "c")))
        n = t.write(rows(spark, (2, "P", 2, "new")), doomed=spark.createDataFrame([(1,), (2,)], "k long"))
        assert n == 1 and live(t) == [(2, "new"), (3, "c")]
        assert sorted((r.k, bool(r._is_deleted)) for r in t.increment(0, with_deletes=True).collect()) == [(1, True), (2, False)]
        assert live(t, as_of=0) == [(1, "a"), (2, "b"), (3, "c")]
        got = {(r.k, r.change, r.before and r.before.v, r.after and r.after.v) for r in t.changes(0).collect()}
        assert got == {(1, "delete", "a", None), (2, "update", "b", "new")}


def test_snapshot_as_of_and_its_reach(spark, tmp_root):
    t = table(spark, tmp_root, keep_versions=2, keep_commits=1, buckets=1)
    for i in range(5):
        t.write(rows(spark, (i, "P", i, str(i))))
    assert live(t, as_of=3) == [(i, str(i)) for i in range(4)] and len(live(t, as_of=4)) == 5
    for bad in (0, 1, 5, -1):
        with pytest.raises(ValueError):
            t.snapshot(as_of=bad)


def test_get_or_insert(spark, tmp_root):
    t = table(spark, tmp_root)
    empty = rows(spark, (1, "P", 1, "x")).limit(0)
    assert t.get_or_insert(empty).count() == 0
    t.write(rows(spark, (1, "P", 1, "old")))
    got = t.get_or_insert(rows(spark, (1, "P", 9, "no"), (2, "P", 1, "first"), (2, "P", 2, "second")), tag="w#1")
    t.write(rows(spark, (2, "P", 9, "later")))
    assert sorted((r.k, r.v) for r in got.collect()) == [(1, "old"), (2, "second")]  # as of its commit
    assert sorted((r.k, r.v) for r in t.get_or_insert(rows(spark, (1, "P", 9, "no"), (2, "P", 2, "x"))).collect()) == [(1, "old"), (2, "later")]
    assert t.commits() == [0, 1, 2]


def test_retracted_gold_rows(spark, tmp_root):
    orders = KeyedTable(spark, TableSpec(name="orders", path=f"{tmp_root}/o", keys="orderid", precombine="ts"))
    customers = KeyedTable(spark, TableSpec(name="customers", path=f"{tmp_root}/c", keys="customer_id", precombine="ts"))
    gold = KeyedTable(spark, gold_spec(f"{tmp_root}/g"))
    order = lambda *r: spark.createDataFrame(list(r), "orderid long, customer_id long, ts long, order_value double, priority string")
    customer = lambda *ids: spark.createDataFrame([(i, "n", "s", "c", "e", 1) for i in ids], "customer_id long, name string, state string, city string, email string, ts long")

    def step():
        made = run_gold(spark, orders, customers, gold, f"{tmp_root}/p").commit
        return made, sorted((r.orderid, r.customer_id) for r in gold.snapshot().collect())

    orders.write(order((1, 1, 1, 1.0, "L"), (2, 1, 1, 1.0, "L"), (3, 2, 1, 1.0, "L")))
    customers.write(customer(1, 2))
    assert step() == (0, [(1, 1), (2, 1), (3, 2)])
    orders.write(order((1, 2, 2, 1.0, "L")))
    assert step() == (1, [(1, 2), (2, 1), (3, 2)])  # rows and removals in one commit
    orders.write(order((2, 7, 2, 1.0, "L")))
    assert step()[1] == [(1, 2), (3, 2)]  # its new customer is not there yet
    customers.write(spark.createDataFrame([(2,)], "customer_id long"), "delete")
    assert step()[1] == []
    assert sorted(r.orderid for r in pending_orders(spark, f"{tmp_root}/p", "gold_orders", orders).collect()) == [1, 2, 3]
    customers.write(customer(2, 7))
    assert step()[1] == [(1, 2), (2, 7), (3, 2)]
    orders.write(spark.createDataFrame([(1,), (3,)], "orderid long"), "delete")
    assert step()[1] == [(2, 7)]


def land(root, name, *docs):
    os.makedirs(f"{root}/raw", exist_ok=True)
    with open(f"{root}/raw/{name}.json", "w") as f:
        f.write("".join((d if isinstance(d, str) else json.dumps(d)) + "\n" for d in docs))


def test_drifting_fields(spark, tmp_root):
    t = KeyedTable(spark, TableSpec(name="t", path=f"{tmp_root}/t", keys="id", precombine="ts"))

    def ingest():
        run_silver(spark, f"{tmp_root}/raw", t, None, f"{tmp_root}/ck")
        return {r.id: r.asDict() for r in t.snapshot().drop("commit").collect()}

    land(tmp_root, "a", {"id": "1", "ts": "a", "n": 5, "x": None, "m": {"q": 1}}, {"id": "2", "ts": "a", "n": 6}, "{broken", "")
    first = ingest()
    assert first["1"] == {"id": "1", "ts": "a", "n": 5, "m": '{"q":1}', "_rescued": None} and set(first) == {"1", "2"}
    land(tmp_root, "b", {"id": "3", "ts": "b", "n": "six", "x": 1.5, "N": 3, "commit": 9, "l": [1, "a"], "b": True},
         {"id": "2", "ts": "c", "n": 7, "x": 2, "b": False}, {"id": "4", "ts": "d", "n": 7.5}, "[1]", "7")
    second = ingest()
    assert json.loads(second["3"]["_rescued"]) == {"n": "six", "N": "3", "commit": "9"}
    assert (second["3"]["n"], second["3"]["x"], second["3"]["l"], second["3"]["b"]) == (None, 1.5, '[1,"a"]', True)
    assert (second["2"]["n"], second["2"]["x"], second["2"]["_rescued"]) == (7, 2.0, None)
    assert json.loads(second["4"]["_rescued"]) == {"n": "7.5"} and second["1"]["x"] is None
    assert sorted(r.line for r in spark.read.json(f"{t.root}/_quarantine").collect()) == ["7", "[1]", "{broken"]
    kinds = dict(t.snapshot().dtypes)
    assert (kinds["n"], kinds["x"], kinds["b"], kinds["l"], kinds["m"]) == ("bigint", "double", "boolean", "string", "string")


def test_rare_field_names_are_kept_aside(spark):
    lines = spark.createDataFrame([(json.dumps({"id": str(i), f"f{i}": i, "common": i}),) for i in range(30)], "value string")
    schema = drift.infer(lines, spark.createDataFrame([], "id string").schema, max_fields=2)
    assert schema.fieldNames() == ["id", "common"]
    got = {r.id: r for r in drift.conform(lines, schema).collect()}
    assert all(json.loads(got[str(i)]._rescued) == {f"f{i}": str(i)} and got[str(i)].common == i for i in range(30))


def files(t):
    return {f for f in glob.glob(f"{t.base_dir}/**/*.parquet", recursive=True)}


def current_files(t):
    return {f for b, v in t._manifest(t.base_versions()[-1]).items() for f in glob.glob(f"{t.base_dir}/_v={v}/_bucket={b}/**/*.parquet", recursive=True)}


def keys_of_bucket(t, bucket, n=3):
    f = t.spark.range(1000).withColumnRenamed("id", "k").withColumn("b", t._bucket()).where(F.col("b") == bucket)
    return [r.k for r in f.limit(n).collect()]


def test_compaction_by_bucket(spark, tmp_root):
    t = table(spark, tmp_root, table_type="mor", buckets=8, compact_every=100)
    t.write(rows(spark, *[(i, "P", 1, "a") for i in range(200)]))
    t.compact()
    before = current_files(t)
    ks = keys_of_bucket(t, 5)
    t.write(rows(spark, *[(k, "P", 2, "b") for k in ks]))
    t.write(spark.createDataFrame([(ks[0],)], "k long"), "delete")
    t.compact()
    after = current_files(t)
    assert {f for f in before if "_bucket=5" not in f} <= after and not {f for f in before if "_bucket=5" in f} & after
    assert live(t) == sorted((i, "b" if i in ks else "a") for i in set(range(200)) | set(ks) if i != ks[0])


def test_incremental_clustering(spark, tmp_root):
    t = table(spark, tmp_root, buckets=4)
    t.write(rows(spark, *[(i, "P", 1, f"v{i}") for i in range(100)]))
    assert t.cluster(["v"]) == 1
    done = current_files(t)
    assert t.cluster(["v"]) is None  # nothing left to do
    k = keys_of_bucket(t, 2, 1)[0]
    t.write(rows(spark, (k, "P", 2, "new")))
    assert t.cluster(["v"]) == 3
    kept = {f for f in done if "_bucket=2" not in f}
    assert kept <= current_files(t) and len(live(t)) == len({*range(100), k})
    assert t.cluster(["k"], small_bytes=1) is None  # no file is small
    assert t.cluster(["k"]) == 4


def test_statistics_come_from_footers(spark, tmp_root):
    t = table(spark, tmp_root, partition_by="p", buckets=2)
    t.write(spark.createDataFrame([(i, "PQ"[i % 2], i, None if i % 5 else "x") for i in range(100)], "k long, p string, ts long, v string"))
    stats = t.column_stats(["k", "ts"])
    assert "PushedAggregation: [COUNT" in stats._jdf.queryExecution().executedPlan().toString()
    assert "MIN(k)" in stats._jdf.queryExecution().executedPlan().toString()
    got = [r for r in stats.collect() if r.column == "k"]
    assert len(got) == 4 and sum(r.num_rows for r in got) == 100 and min(int(r.min) for r in got) == 0
    assert all(r.directory.startswith("_v=0/_bucket=") and "/p=" in r.directory for r in got)
    text = [r for r in t.column_stats(["v"]).collect()]
    assert sum(r.nulls for r in text) == 80 and {r.max for r in text if r.max} == {"x"}


def test_statistics_of_new_null_and_nested_columns(spark, tmp_root):
    """The push-down finds columns by place and fails on files without bounds: such columns are read."""
    t = table(spark, tmp_root, buckets=2)
    t.write(spark.createDataFrame([(i, i, None, [i], float("nan") if i == 3 else float(i)) for i in range(20)],
                                  "k long, ts long, empty long, a array<long>, x double"))
    t.write(spark.createDataFrame([(100, 7, 5, [1], 2.0, {"m": "n"}, 11, 70)],
                                  "k long, ts long, empty long, a array<long>, x double, m map<string,string>, late long, later long"))
    got = {}
    stats = t.column_stats(["k", "empty", "x", "late", "later", "commit"])
    for r in stats.collect():
        lo, hi, nulls, n = got.get(r.column, (None, None, 0, 0))
        bounds = [float(b) for b in (lo, hi, r.min, r.max) if b is not None]
        got[r.column] = (min(bounds, default=None), max(bounds, default=None), nulls + r.nulls, n + r.num_rows)
    assert got["k"] == (0, 100, 0, 21) and got["empty"] == (5, 5, 20, 21) and got["late"] == (11, 11, 20, 21)
    assert got["later"] == (70, 70, 20, 21) and got["commit"] == (0, 1, 0, 21) and got["x"][2:] == (0, 21)
    assert "MIN(k)" in stats._jdf.queryExecution().executedPlan().toString()


def test_jobs_of_a_commit(spark, tmp_root):
    """A copy-on-write commit of few rows: a bounded number of jobs, and stored rows are not exchanged."""
    t = table(spark, tmp_root)
    t.write(rows(spark, *[(i, "P", 1, "a") for i in range(100)]))
    sc = spark.sparkContext
    sc.setJobGroup("commit", "one commit")
    t.write(rows(spark, *[(i, "P", 2, "b") for i in range(0, 100, 10)]))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("commit")) <= 9


def test_equal_times_with_maps(spark):
    df = spark.createDataFrame([(1, 5, {"a": "x", "b": "y"}), (1, 5, {"b": "z", "a": "x"}), (1, 5, {"a": "w"})], "k long, ts long, m map<string,string>")
    want = None
    for order in ([0, 1, 2], [2, 1, 0], [1, 2, 0]):
        got = merge.precombine(spark.createDataFrame([df.collect()[i] for i in order], df.schema), "k", "ts").first().m
        want = want or got
        assert got == want == {"a": "x", "b": "z"}


def test_catalog_is_altered_not_dropped(spark, tmp_root):
    name = "strata_test_db.swap"
    t = table(spark, tmp_root, table_type="mor", partition_by="p", compact_every=100, catalog_table=name)
    t.write(rows(spark, (1, "P", 1, "a"), (2, "Q", 1, "b")))
    t.register()
    t.write(rows(spark, (1, "Q", 2, "c")).withColumn("extra", F.lit(1)))
    assert t.base_versions() == [0]  # a commit does not compact
    assert sorted(r.v for r in spark.table(name).collect()) == ["a", "b"]
    t.compact()
    t.register()
    assert sorted((r.k, r.p, r.v, r.extra) for r in spark.table(name).collect()) == [(1, "Q", "c", 1), (2, "Q", "b", None)]
    other = table(spark, f"{tmp_root}/other", catalog_table=name)
    with pytest.raises(ValueError, match="another table"):
        other.write(rows(spark, (1, "P", 1, "a")))
    spark.sql(f"DROP TABLE {name}")
