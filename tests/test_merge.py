"""Keyed write semantics on a few hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.functions.scalar import key_list
from strata.operators import merge, versions
from strata.spec import TableSpec, as_bool

T1 = dt.datetime(2024, 1, 1, 10)
T2 = dt.datetime(2024, 1, 2, 10)
SCHEMA = "k long, ts timestamp_ntz, v string, commit long"


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_null_precombine_loses(spark):
    df = spark.createDataFrame([(1, None, "a", 0), (1, T1, "b", 0)], SCHEMA)
    assert rows(merge.precombine(df, "k", "ts"), "k", "v") == [(1, "b")]


def test_all_null_precombine_keeps_a_real_row(spark):
    df = spark.createDataFrame([(1, None, "a", 0), (1, None, "b", 0)], SCHEMA)
    out = merge.precombine(df, "k", "ts").collect()
    assert len(out) == 1 and out[0]["v"] == "b" and out[0]["k"] == 1


def test_tie_is_deterministic(spark):
    df = spark.createDataFrame([(1, T1, "a", 0), (1, T1, "b", 0)], SCHEMA)
    for _ in range(3):
        assert rows(merge.precombine(df.repartition(3), "k", "ts"), "v") == [("b",)]


def test_late_row_arrival_vs_event_time(spark):
    base = spark.createDataFrame([(1, T2, "new", 1)], SCHEMA)
    late = spark.createDataFrame([(1, T1, "late", 2)], SCHEMA)
    assert rows(merge.upsert(base, late, "k", "ts", "arrival"), "v") == [("late",)]
    assert rows(merge.upsert(base, late, "k", "ts", "event_time"), "v") == [("new",)]


def test_upsert_keeps_untouched_and_inserts_new(spark):
    base = spark.createDataFrame([(1, T1, "a", 0), (2, T1, "b", 0)], SCHEMA)
    batch = spark.createDataFrame([(2, T2, "b2", 1), (3, T2, "c", 1)], SCHEMA)
    assert rows(merge.upsert(base, batch, "k", "ts"), "k", "v") == [(1, "a"), (2, "b2"), (3, "c")]


def test_upsert_is_idempotent(spark):
    base = spark.createDataFrame([(1, T1, "a", 0), (2, T1, "b", 0)], SCHEMA)
    batch = spark.createDataFrame([(2, T2, "b2", 1), (3, T2, "c", 1)], SCHEMA)
    once = merge.upsert(base, batch, "k", "ts")
    twice = merge.upsert(once, batch, "k", "ts")
    assert rows(once, "*") == rows(twice, "*")


def test_null_key_matches_null_key(spark):
    base = spark.createDataFrame([(None, T1, "a", 0)], SCHEMA)
    batch = spark.createDataFrame([(None, T2, "b", 1)], SCHEMA)
    assert rows(merge.upsert(base, batch, "k", "ts"), "v") == [("b",)]


def test_partition_move_global_vs_partition_scope(spark):
    s = "k long, p string, ts timestamp_ntz, commit long"
    log = spark.createDataFrame([(1, "P", T1, 0), (1, "Q", T2, 1)], s)
    glob = TableSpec(name="t", path="/x", keys="k", partition_by="p", scope="global")
    part = TableSpec(name="t", path="/x", keys="k", partition_by="p", scope="BLOOM")
    assert rows(versions.snapshot(log, glob.merge_keys, "ts"), "p") == [("Q",)]
    assert rows(versions.snapshot(log, part.merge_keys, "ts"), "p") == [("P",), ("Q",)]


def test_composite_key(spark):
    s = "a long, b string, ts timestamp_ntz, commit long"
    log = spark.createDataFrame([(1, "x", T1, 0), (1, "y", T1, 0), (1, "x", T2, 1)], s)
    out = versions.snapshot(log, "a, b", "ts")
    assert rows(out, "a", "b", "commit") == [(1, "x", 1), (1, "y", 0)]
    assert key_list("orderid,customer_id") == ["orderid", "customer_id"]


def test_insert_if_absent_never_changes_stored_rows(spark):
    base = spark.createDataFrame([(1, T1, "a", 0)], SCHEMA)
    batch = spark.createDataFrame([(1, T2, "changed", 1), (2, T2, "new", 1)], SCHEMA)
    assert rows(merge.insert_if_absent(base, batch, "k", "ts"), "k", "v") == [(1, "a"), (2, "new")]


def test_delete_overwrite_bulk(spark):
    s = "k long, p string, v string"
    base = spark.createDataFrame([(1, "P", "a"), (2, "P", "b"), (3, "Q", "c")], s)
    assert rows(merge.delete_keys(base, spark.createDataFrame([(2,)], "k long"), "k"), "k") == [(1,), (3,)]
    batch = spark.createDataFrame([(9, "P", "z")], s)
    assert rows(merge.insert_overwrite(base, batch, "p"), "k") == [(3,), (9,)]
    assert merge.bulk_insert(base, base).count() == 6


def test_increment_filters_and_keeps_latest(spark):
    log = spark.createDataFrame([(1, T1, "a", 0), (1, T2, "b", 1), (2, T1, "c", 0), (3, T1, "d", 2)], SCHEMA)
    assert rows(versions.increment(log, 0, "k", "ts"), "k", "v") == [(1, "b"), (3, "d")]
    assert rows(versions.increment(log, 0, "k", "ts", until=1), "k") == [(1,)]


def test_event_time_increment_drops_late_losers(spark):
    log = spark.createDataFrame([(1, T2, "new", 0), (1, T1, "late", 1)], SCHEMA)
    assert versions.increment(log, 0, "k", "ts", "event_time").count() == 0
    assert rows(versions.increment(log, 0, "k", "ts", "arrival"), "v") == [("late",)]


def test_commit_helpers(spark):
    log = spark.createDataFrame([(1, T1, "a", 3), (2, T1, "b", 5), (3, T1, "c", 5)], SCHEMA)
    assert versions.begin_commit(log).first()[0] == 2
    assert versions.last_commit(log).first()[0] == 5
    assert [r[0] for r in versions.commit_list(log, 1).collect()] == [3]


def test_retain_versions(spark):
    log = spark.createDataFrame([(1, T1, str(c), c) for c in range(5)] + [(2, T1, "x", 0)], SCHEMA)
    assert rows(versions.retain_versions(log, "k", 3), "k", "commit") == [(1, 2), (1, 3), (1, 4), (2, 0)]


def test_flags_and_validation(spark):
    assert as_bool(True) and as_bool("True") and as_bool("true")
    assert not as_bool("False") and not as_bool("yes") and not as_bool(1) and not as_bool(None)
    with pytest.raises(ValueError):
        TableSpec(name="t", path="/x", keys="k", scope="nope")
    with pytest.raises(ValueError):
        TableSpec(name="t", path="/x", keys="k", table_type="nope")
    with pytest.raises(ValueError):
        TableSpec(name="t", path="/x", keys="k", ordering="event_time")
    with pytest.raises(ValueError):
        TableSpec(name="t", path="/x", keys="")
    assert TableSpec(name="t", path="/x", keys="k", table_type="MERGE_ON_READ").table_type == "mor"
    df = spark.createDataFrame([(1, T1, "a", 0)], SCHEMA)
    with pytest.raises(ValueError):
        merge.apply_write(df, df, "merge", "k")
    with pytest.raises(ValueError):
        merge.upsert(df, df, "k", "ts", "sideways")


def test_no_python_in_plans(spark):
    df = spark.createDataFrame([(1, T1, "a", 0), (1, T2, "b", 1)], SCHEMA)
    plan = merge.upsert(df, df.withColumn("commit", F.lit(2).cast("long")), "k", "ts", "event_time")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "ArrowEval" not in text
