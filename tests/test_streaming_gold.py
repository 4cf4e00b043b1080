"""New-files ingest, restarts, and the gold job's progress, pending rows and refresh."""

import pytest
from pyspark.sql import functions as F

from strata.plans.chain import ORDERS_SCHEMA
from strata.plans.gold import gold_spec, pending_orders, run_gold
from strata.sources.inventory import file_inventory, find_one, item_exists
from strata.sources.raw import read_raw, write_landing
from strata.sources.table import KeyedTable
from strata.spec import TableSpec
from strata.streaming.ingest import run_silver
from strata.streaming.progress import Progress


def orders_rows(spark, rows):
    return spark.createDataFrame(rows, "orderid string, customer_id string, ts string, order_value string, priority string")


def silver(spark, root):
    return KeyedTable(spark, TableSpec(name="orders", path=f"{root}/silver", keys="orderid", precombine="ts"))


def test_new_files_only_and_nested(spark, tmp_root):
    t = silver(spark, tmp_root)
    write_landing(orders_rows(spark, [("1", "c1", "2024-01-01T00:00:00", "10", "LOW")]), f"{tmp_root}/raw/a")
    assert run_silver(spark, f"{tmp_root}/raw", t, ORDERS_SCHEMA, f"{tmp_root}/ck") == [0]
    assert run_silver(spark, f"{tmp_root}/raw", t, ORDERS_SCHEMA, f"{tmp_root}/ck") == []  # nothing new
    write_landing(orders_rows(spark, [("1", "c1", "2024-01-02T00:00:00", "99", "URGENT"),
                                      ("2", "c2", "2024-01-01T00:00:00", "5", "LOW")]), f"{tmp_root}/raw/b/sub")
    assert run_silver(spark, f"{tmp_root}/raw", t, ORDERS_SCHEMA, f"{tmp_root}/ck") == [1]
    got = sorted((r["orderid"], r["order_value"]) for r in t.snapshot().collect())
    assert got == [("1", "99"), ("2", "5")]
    assert read_raw(spark, f"{tmp_root}/raw").count() == 3
    assert file_inventory(spark, f"{tmp_root}/raw", prefix="b/").count() >= 1
    assert find_one(spark, f"{tmp_root}/raw", r"/b/sub/.*\.json$") is not None
    assert item_exists(spark, f"{tmp_root}/raw/a") and not item_exists(spark, f"{tmp_root}/raw/zzz")
    with pytest.raises(ValueError):
        read_raw(spark, f"{tmp_root}/raw", "csv")


def test_corrupt_lines_are_quarantined(spark, tmp_root):
    t = silver(spark, tmp_root)
    write_landing(orders_rows(spark, [("1", "c1", "2024-01-01T00:00:00", "10", "LOW")]), f"{tmp_root}/raw/ok")
    spark.createDataFrame([("{bad",)], "value string").write.text(f"{tmp_root}/raw/broken")
    run_silver(spark, f"{tmp_root}/raw", t, ORDERS_SCHEMA, f"{tmp_root}/ck", quarantine=f"{tmp_root}/q")
    assert [r["orderid"] for r in t.snapshot().collect()] == ["1"]
    assert spark.read.json(f"{tmp_root}/q").count() == 1


def test_failure_inside_batch_then_rerun(spark, tmp_root):
    """The sink fails after writing its data; the rerun repeats the batch, each row lands once."""
    t = silver(spark, tmp_root)
    write_landing(orders_rows(spark, [("1", "c1", "2024-01-01T00:00:00", "10", "LOW")]), f"{tmp_root}/raw/a")
    original = t._mark
    calls = {"n": 0}

    def failing_mark(sub, n, suffix=""):
        calls["n"] += 1
        raise RuntimeError("executor lost before the commit marker")

    t._mark = failing_mark
    with pytest.raises(Exception):
        run_silver(spark, f"{tmp_root}/raw", t, ORDERS_SCHEMA, f"{tmp_root}/ck")
    assert calls["n"] == 1 and t.commits() == []
    t._mark = original
    write_landing(orders_rows(spark, [("2", "c2", "2024-01-01T00:00:00", "5", "LOW")]), f"{tmp_root}/raw/b")
    made = run_silver(spark, f"{tmp_root}/raw", t, ORDERS_SCHEMA, f"{tmp_root}/ck")
    assert made[0] == 0  # the retried batch rewrote the same commit
    assert sorted(r["orderid"] for r in t.snapshot().collect()) == ["1", "2"]
    assert t.log().groupBy("orderid").count().where("count > 1").count() == 0


def _tables(spark, root):
    orders = KeyedTable(spark, TableSpec(name="orders", path=f"{root}/o", keys="orderid", precombine="ts",
                                         table_type="mor"))
    customers = KeyedTable(spark, TableSpec(name="customers", path=f"{root}/c", keys="customer_id",
                                            precombine="ts", partition_by="state"))
    gold = KeyedTable(spark, gold_spec(f"{root}/g"))
    return orders, customers, gold


def _o(spark, rows):
    return spark.createDataFrame(rows, "orderid long, customer_id long, ts string, order_value double, priority string")


def _c(spark, rows):
    return spark.createDataFrame(rows, "customer_id long, name string, state string, city string, email string, ts string")


def test_gold_pending_refresh_and_progress(spark, tmp_root):
    orders, customers, gold = _tables(spark, tmp_root)
    prog = f"{tmp_root}/progress"
    assert run_gold(spark, orders, customers, gold, prog).commit is None  # empty tables: no-op
    orders.write(_o(spark, [(1, 10, "t1", 5.0, "LOW"), (2, 20, "t1", 6.0, "HIGH")]))
    customers.write(_c(spark, [(10, "ann", "S1", "X", "a@x", "t0")]))
    r = run_gold(spark, orders, customers, gold, prog)
    assert r.commit == 0 and gold.snapshot().count() == 1
    assert [x["orderid"] for x in pending_orders(spark, prog, "gold_orders", orders).collect()] == [2]
    assert run_gold(spark, orders, customers, gold, prog).commit is None  # nothing new
    customers.write(_c(spark, [(20, "bob", "S2", "Y", "b@y", "t0")]))  # the late customer
    run_gold(spark, orders, customers, gold, prog)
    assert sorted(x["orderid"] for x in gold.snapshot().collect()) == [1, 2]
    assert pending_orders(spark, prog, "gold_orders", orders).count() == 0
    customers.write(_c(spark, [(10, "ann", "S1", "X", "new@x", "t1")]))
    run_gold(spark, orders, customers, gold, prog, refresh_dim=True)
    emails = {x["orderid"]: x["email"] for x in gold.snapshot().collect()}
    assert emails == {1: "new@x", 2: "b@y"}
    doc = Progress(spark, prog, "gold_orders").read()
    assert doc["sources"]["orders"]["last_processed_commit"] == 0
    assert doc["sources"]["customers"]["last_processed_commit"] == 2


def test_gold_failure_before_progress_is_repeated(spark, tmp_root):
    orders, customers, gold = _tables(spark, tmp_root)
    prog = f"{tmp_root}/progress"
    orders.write(_o(spark, [(1, 10, "t1", 5.0, "LOW")]))
    customers.write(_c(spark, [(10, "ann", "S1", "X", "a@x", "t0")]))
    original = Progress.write

    def boom(self, sources):
        raise RuntimeError("driver lost after the gold write")

    Progress.write = boom
    try:
        with pytest.raises(RuntimeError):
            run_gold(spark, orders, customers, gold, prog)
    finally:
        Progress.write = original
    assert gold.commits() == [0]
    orders.write(_o(spark, [(3, 10, "t2", 7.0, "LOW")]))
    r = run_gold(spark, orders, customers, gold, prog)
    assert r.commit == 1  # the rerun covers a wider range: a new gold commit, upserted again
    assert sorted(x["orderid"] for x in gold.snapshot().collect()) == [1, 3]
    Progress(spark, prog, "gold_orders").reset()
    assert Progress(spark, prog, "gold_orders").read() is None


def test_increment_after_filter_uses_partition_pruning(spark, tmp_root):
    orders, _, _ = _tables(spark, tmp_root)
    for i in range(3):
        orders.write(_o(spark, [(i, 10, f"t{i}", 1.0, "LOW")]))
    plan = orders.increment(1)._jdf.queryExecution().executedPlan().toString()
    assert "commit=2" in plan or "PartitionFilters: [isnotnull(commit" in plan
    assert orders.increment(1).select(F.max("orderid")).first()[0] == 2


def test_gold_with_user_sql(spark, tmp_root):
    orders, customers, gold = _tables(spark, tmp_root)
    orders.write(_o(spark, [(1, 10, "t1", 5.0, "LOW"), (2, 10, "t1", 6.0, "HIGH"), (3, 30, "t1", 1.0, "HIGH")]))
    customers.write(_c(spark, [(10, "ann", "S1", "X", "a@x", "t0")]))
    sql = """SELECT c.customer_id, c.name, c.state, c.city, upper(c.email) AS email, o.orderid,
                    o.ts AS order_ts, o.order_value, o.priority
             FROM customers c JOIN orders o ON c.customer_id = o.customer_id WHERE o.priority = 'HIGH'"""
    run_gold(spark, orders, customers, gold, f"{tmp_root}/p", sql=sql)
    assert [(r["orderid"], r["email"]) for r in gold.snapshot().collect()] == [(2, "A@X")]
    assert [r["orderid"] for r in pending_orders(spark, f"{tmp_root}/p", "gold_orders", orders).collect()] == [3]
