"""Property tests: folding batches one by one equals one precombine over all of them."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import merge, versions

SCHEMA = "k long, ts timestamp_ntz, v long, commit long"
T0 = dt.datetime(2024, 1, 1)

row = st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 3))
rows_st = st.lists(row, min_size=1, max_size=14)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _frame(spark, rows, k):
    """Rows spread over k commits in list order."""
    data = [(key, None if ts is None else T0 + dt.timedelta(hours=ts), v, i * k // len(rows))
            for i, (key, ts, v) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def _set(df):
    return sorted(tuple(r) for r in df.select("k", "ts", "v", "commit").collect())


@SETTINGS
@given(rows=rows_st, k=st.integers(1, 3))
def test_event_time_fold_equals_single_precombine(spark, rows, k):
    df = _frame(spark, rows, k)
    batches = [df.where(F.col("commit") == c) for c in range(k)]
    folded = merge.fold_batches([b for b in batches], "k", "ts", "event_time")
    whole = versions.snapshot(df, "k", "ts", "event_time")
    assert _set(folded) == _set(whole)


@SETTINGS
@given(rows=rows_st, k=st.integers(1, 3))
def test_arrival_fold_equals_log_snapshot_and_increments_compose(spark, rows, k):
    df = _frame(spark, rows, k)
    folded = merge.fold_batches([df.where(F.col("commit") == c) for c in range(k)], "k", "ts", "arrival")
    assert _set(folded) == _set(versions.snapshot(df, "k", "ts", "arrival"))
    # the increment after commit 0, upserted onto the snapshot as of commit 0, is the snapshot
    first = versions.snapshot(df.where(F.col("commit") == 0), "k", "ts")
    inc = versions.increment(df, 0, "k", "ts")
    assert _set(merge.upsert(first, inc, "k", "ts")) == _set(folded)


@SETTINGS
@given(rows=rows_st)
def test_insert_if_absent_keeps_stored_rows(spark, rows):
    df = _frame(spark, rows, 2)
    base = versions.snapshot(df.where(F.col("commit") == 0), "k", "ts")
    out = merge.insert_if_absent(base, df.where(F.col("commit") == 1), "k", "ts")
    assert set(_set(base)) <= set(_set(out))
    assert out.select("k").distinct().count() == out.count()
