"""The chained run raw -> silver -> gold, re-runnable: silver jobs first, then gold.

Layout under ``root``::

    raw/orders/, raw/customers/        landing zone (JSON objects)
    silver/orders, silver/customers    keyed tables
    gold/gold_orders                   keyed table
    _checkpoints/...                   stream checkpoints and gold progress
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.functions.scalar import iso_text
from strata.plans.gold import GoldRun, gold_spec, run_gold
from strata.sources.table import KeyedTable
from strata.spec import TableSpec
from strata.streaming.ingest import run_silver

# Landing record schemas (every field arrives as JSON text).
ORDER_FIELDS = ("orderid", "customer_id", "ts", "order_value", "priority")
CUSTOMER_FIELDS = ("customer_id", "name", "state", "city", "email", "ts")

ORDERS_SCHEMA = StructType([StructField(c, StringType(), True) for c in ORDER_FIELDS])
CUSTOMERS_SCHEMA = StructType([StructField(c, StringType(), True) for c in CUSTOMER_FIELDS])


def orders_text(df: DataFrame) -> DataFrame:
    """Typed orders -> landing text: ISO timestamp, amount with two decimals."""
    return df.select(
        F.col("orderid").cast("string").alias("orderid"),
        F.col("customer_id").cast("string").alias("customer_id"),
        iso_text("ts").alias("ts"),
        F.col("order_value").cast("decimal(18,2)").cast("string").alias("order_value"),
        F.col("priority").cast("string").alias("priority"),
    )


def customers_text(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("customer_id").cast("string").alias("customer_id"),
        "name", "state", "city", "email",
        iso_text("ts").alias("ts"),
    )


@dataclass
class Chain:
    root: str

    def orders_spec(self) -> TableSpec:
        return TableSpec(name="orders", path=f"{self.root}/silver/orders", keys="orderid", precombine="ts")

    def customers_spec(self) -> TableSpec:
        # partitioned by state; a customer who moves state moves partition (global key scope)
        return TableSpec(name="customers", path=f"{self.root}/silver/customers", keys="customer_id",
                         precombine="ts", partition_by="state", scope="global")

    def tables(self, spark: SparkSession) -> tuple[KeyedTable, KeyedTable, KeyedTable]:
        return (KeyedTable(spark, self.orders_spec()), KeyedTable(spark, self.customers_spec()),
                KeyedTable(spark, gold_spec(f"{self.root}/gold/gold_orders")))

    def run(self, spark: SparkSession, refresh_dim: bool = False) -> GoldRun:
        orders, customers, gold = self.tables(spark)
        ck = f"{self.root}/_checkpoints"
        run_silver(spark, f"{self.root}/raw/customers", customers, CUSTOMERS_SCHEMA, f"{ck}/ingest_customers",
                   quarantine=f"{self.root}/quarantine/customers")
        run_silver(spark, f"{self.root}/raw/orders", orders, ORDERS_SCHEMA, f"{ck}/ingest_orders",
                   quarantine=f"{self.root}/quarantine/orders")
        return run_gold(spark, orders, customers, gold, f"{ck}/gold", refresh_dim=refresh_dim)
