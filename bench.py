"""Headline timings: one JSON line on stdout.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Every query is forced to completion with the ``noop`` sink (full evaluation, nothing
collected to the driver); queries that build tables include their writes in the time.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from strata.plans.registry import QUERIES  # noqa: E402
from strata.session import build_session, checkpoint_root, scratch_dir  # noqa: E402
from strata.sources.table import KeyedTable  # noqa: E402
from strata.sources.testdata import table  # noqa: E402
from strata.spec import TableSpec  # noqa: E402

HEADLINE = [
    "precombine",
    "upsert_arrival",
    "upsert_event_time",
    "retain_versions",
    "gold_orders",
    "snapshot_read",
    "mor_equals_cow",
    "incremental_read",
    "incremental_read_event_time",
    "gold_incremental",
    "loader_views",
    "late_dimension",
    "bookmark_new_files",
    "layered_chain",
    "gold_stream",
]


def _lineitem_table(spark, sf, ttype):
    spec = TableSpec(name="lineitem", path=scratch_dir(spark, f"bench_li_{ttype}"), keys="l_orderkey,l_linenumber",
                     precombine="l_shipdate", table_type=ttype)
    t = KeyedTable(spark, spec)
    t.write(table(spark, sf, "lineitem"))
    return t


def _upsert_10pct(ttype):
    """Write lineitem, then upsert a 10% batch of changed lines; time covers both commits and a read."""
    def run(spark, sf):
        t = _lineitem_table(spark, sf, ttype)
        li = table(spark, sf, "lineitem")
        changed = li.where(F.col("l_orderkey") % 10 == 0).withColumn("l_quantity", F.col("l_quantity") + 1)
        t.write(changed)
        return t.snapshot()
    return run


def _snapshot_after_compaction(spark, sf):
    t = _lineitem_table(spark, sf, "mor")
    li = table(spark, sf, "lineitem")
    for c in range(4):
        t.write(li.where(F.col("l_orderkey") % 4 == c).withColumn("l_tax", F.col("l_tax") + c))
    t.compact()
    return t.snapshot()


EXTRA = {
    "lineitem_upsert_10pct_cow": _upsert_10pct("cow"),
    "lineitem_upsert_10pct_mor": _upsert_10pct("mor"),
    "lineitem_mor_compacted_read": _snapshot_after_compaction,
}


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = build_session()
    checkpoint_root(spark)  # raises on a cluster without a shared folder
    # JVM / code-generation warm-up on a query outside the timed set
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    (o.join(c, o.o_custkey == c.c_custkey).groupBy("c_mktsegment").agg(F.max("o_orderdate").alias("m"))
     .write.format("noop").mode("overwrite").save())
    only = [a for a in sys.argv[1:]]
    todo = [(n, QUERIES[n]) for n in HEADLINE] + list(EXTRA.items())
    if only:
        todo = [(n, f) for n, f in todo if n in only]
    times = {}
    for name, fn in todo:
        t0 = time.perf_counter()
        fn(spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf_value = sf.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "total_headline_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf_value) if sf_value.replace(".", "", 1).isdigit() else sf_value,
    }))


if __name__ == "__main__":
    main()
