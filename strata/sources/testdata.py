"""Feeds in the shape of the pipeline's raw records, derived from the driver's parquet tables.

orders     orderid, customer_id, ts, order_value, priority      (from orders)
customers  customer_id, name, state, city, email, ts            (from customer + nation)

Only column mapping happens here; every row of the source tables is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.spec import COMMIT

# The e-mail domain given to fixture customers, and their record time.
EMAIL_DOMAIN = "@example.com"
CUSTOMER_TS = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("orderid"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_totalprice").alias("order_value"),
        F.col("o_orderpriority").alias("priority"),
    )


def customers_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    # nation is the fixed 25-row TPC-H dimension: Catalyst broadcasts it by its measured size
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("n_name").alias("state"),
        F.col("c_mktsegment").alias("city"),
        F.concat(F.lower(F.col("c_name")), F.lit(EMAIL_DOMAIN)).alias("email"),
        F.to_timestamp_ntz(F.lit(CUSTOMER_TS)).alias("ts"),
    )


def events_log(spark: SparkSession, sf_dir: str, commits: int = 4) -> DataFrame:
    """events stamped with an arrival commit ``event_id % commits`` (arrival unlike event time)."""
    e = table(spark, sf_dir, "events")
    return e.withColumn(COMMIT, (F.col("event_id") % F.lit(commits)).cast("bigint"))


def stamp(df: DataFrame, key: str, commits: int) -> DataFrame:
    return df.withColumn(COMMIT, (F.col(key) % F.lit(commits)).cast("bigint"))
