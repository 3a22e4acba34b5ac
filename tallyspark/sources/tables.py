"""Access to the warehouse tables (Parquet) and their retail roles.

Role binding of the driver's TPC-H-like tables to the retail model:
customer -> customer (membership/segment = c_mktsegment, city = c_nationkey),
part -> product (category = p_type, brand = p_brand), supplier -> branch,
nation -> state, region -> region, orders -> customer-side sale,
lineitem -> product/branch-side sale line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.columns import as_date
from tallyspark.session import ensure_session

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Full table scan.  Column pruning and filters reach the Parquet reader."""
    if name not in TABLES:
        raise KeyError(name)
    ensure_session(spark)
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    return spark.read.parquet(path)


class Warehouse:
    """Named access to the tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return table(self.spark, self.sf_dir, name)
        raise AttributeError(name)

    # -- retail roles ---------------------------------------------------
    def sales(self) -> DataFrame:
        """Customer-side sales: one row per order."""
        return self.orders.select(
            F.col("o_orderkey").alias("sale_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("priority"),
            as_date("o_orderdate").alias("sale_date"),
            F.col("o_orderdate").alias("sale_ts"),
            F.col("o_totalprice").alias("amount"),
        )

    def sale_lines(self) -> DataFrame:
        """Product/branch-side sales: one row per line item."""
        return self.lineitem.select(
            F.col("l_orderkey").alias("sale_id"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("branch_id"),
            F.col("l_quantity").cast("long").alias("quantity"),
            F.col("l_extendedprice").alias("amount"),
            as_date("l_shipdate").alias("ship_date"),
        )
