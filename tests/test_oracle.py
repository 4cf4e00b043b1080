"""Every registered query against its DuckDB oracle on sf0.001 (what the driver does at sf0.01)."""

import os

import pytest

from tests.oracle_check import check
from tests.conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver test data not present")


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["customer_id", "name", "state", "city", "email", "orderid", "order_ts",
                          "order_value", "priority"]
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_all_queries_match_oracle(spark):
    import __spark_entry__ as entry

    report = check(spark, SF_SMALL, set(entry.oracle_sql()))
    bad = {k: v for k, v in report.items() if not v.get("ok")}
    assert not bad, bad
