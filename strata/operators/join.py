"""The gold join: changed facts against current dimensions.

Orders meet customers on ``customer_id`` with an inner equi-join.  Catalyst / AQE choose the
strategy from sizes: the customer snapshot is broadcast when its measured size is under the
broadcast threshold, otherwise both sides shuffle on ``customer_id`` and AQE splits a customer
that owns a large share of the orders (skew join) instead of sending it to one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.merge import semi_join_keys

# The gold table's columns and record key.
GOLD_COLUMNS = ("customer_id", "name", "state", "city", "email", "orderid", "order_ts", "order_value", "priority")
GOLD_KEYS = "orderid,customer_id"
JOIN_KEY = "customer_id"

_CUSTOMER_COLUMNS = GOLD_COLUMNS[:5]
_SOURCE = {"order_ts": "ts"}


def _gold_sql() -> str:
    """The join as text over the views ``orders`` / ``customers``, for jobs that take user SQL."""
    fields = [f"{'c' if g in _CUSTOMER_COLUMNS else 'o'}.{_SOURCE.get(g, g)} AS {g}" for g in GOLD_COLUMNS]
    return f"SELECT {', '.join(fields)} FROM orders o JOIN customers c ON o.{JOIN_KEY} = c.{JOIN_KEY}"


GOLD_SQL = _gold_sql()


def gold_join(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """DataFrame form of ``GOLD_SQL``."""
    o = orders.select("orderid", "customer_id", F.col("ts").alias("order_ts"), "order_value", "priority")
    c = customers.select("customer_id", "name", "state", "city", "email")
    return c.join(o, JOIN_KEY).select(*GOLD_COLUMNS)


def unmatched(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders whose customer is not present (yet): they wait for a later run."""
    return semi_join_keys(orders, customers.select(JOIN_KEY), [JOIN_KEY], "left_anti")


def touched_by(orders: DataFrame, changed_customers: DataFrame) -> DataFrame:
    """Orders of customers that changed: rejoined so gold shows the new attributes."""
    return semi_join_keys(orders, changed_customers.select(JOIN_KEY), [JOIN_KEY], "left_semi")


def split_join(orders: DataFrame, customers: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One left join of orders with customers, split into (gold rows, unmatched orders).

    Returns (gold, pending, joined); ``joined`` is persisted by the caller's choice; both outputs
    read it, so the customers side is shuffled (or broadcast) once per run, not twice.
    """
    c = customers.select("customer_id", "name", "state", "city", "email", F.lit(True).alias("_matched"))
    joined = orders.join(c, JOIN_KEY, "left")
    gold = joined.where(F.col("_matched")).select(
        *[F.col("ts").alias("order_ts") if g == "order_ts" else F.col(g) for g in GOLD_COLUMNS])
    pending = joined.where(F.col("_matched").isNull()).select(*orders.columns)
    return gold, pending, joined
