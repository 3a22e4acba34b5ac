"""Data-quality checks on the test tables (DQ-1..3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.operators.quality import duplicate_keys, orphans, row_counts, table_differences
from tallyspark.operators.views import materialize
from tallyspark.plans.registry import query
from tallyspark.sources.tables import Warehouse

CORE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@query("duplicate_lineitems", """
SELECT l_orderkey, l_linenumber, CAST(COUNT(*) AS BIGINT) AS duplicate_count
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
""")
def q_duplicate_lineitems(spark, d):
    """DQ-1: (order, line number) pairs that occur more than once."""
    return duplicate_keys(Warehouse(spark, d).lineitem, ["l_orderkey", "l_linenumber"])


@query("duplicate_orders", """
SELECT o_orderkey, CAST(COUNT(*) AS BIGINT) AS duplicate_count
FROM orders GROUP BY o_orderkey HAVING COUNT(*) > 1
""")
def q_duplicate_orders(spark, d):
    """DQ-1 on a key that should be unique (expected empty)."""
    return duplicate_keys(Warehouse(spark, d).orders, ["o_orderkey"])


@query("orphan_orders", """
SELECT o.o_orderkey, o.o_custkey FROM orders o
WHERE o.o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
""")
def q_orphan_orders(spark, d):
    """DQ-2: orders whose customer is missing from the credit-worthy customer
    dimension (customers with a negative balance are not in it)."""
    w = Warehouse(spark, d)
    dim = w.customer.filter(F.col("c_acctbal") >= 0)
    return orphans(w.orders, dim, "o_custkey", "c_custkey", ["o_orderkey", "o_custkey"])


@query("orphan_lineitems", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey FROM lineitem l
WHERE l.l_partkey NOT IN (SELECT p_partkey FROM part)
""")
def q_orphan_lineitems(spark, d):
    """DQ-2: lines pointing at an unknown product (expected empty)."""
    w = Warehouse(spark, d)
    return orphans(w.lineitem, w.part, "l_partkey", "p_partkey", ["l_orderkey", "l_linenumber", "l_partkey"])


@query("row_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM {t}" for t in CORE))
def q_row_counts(spark, d):
    """DQ-3: rows per table after the load."""
    w = Warehouse(spark, d)
    return row_counts({t: getattr(w, t) for t in CORE})


@query("table_differences", """
SELECT o_orderkey, CASE WHEN o_orderkey = (SELECT min(o_orderkey) FROM orders) THEN 'only left'
                        ELSE 'changed' END AS difference
FROM orders WHERE o_orderkey IN ((SELECT min(o_orderkey) FROM orders), (SELECT max(o_orderkey) FROM orders))
UNION ALL SELECT -1, 'only right'
""")
def q_table_differences(spark, d):
    """DQ-8: orders against a copy that lost its first order, has another price
    in its last one and one order too many; only the key buckets whose sums
    differ are compared row by row."""
    o = Warehouse(spark, d).orders
    ends = o.agg(F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"))
    lo, hi = ends.first()
    copy = o.filter(F.col("o_orderkey") != lo).withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") == hi, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    extra = o.filter(F.col("o_orderkey") == hi).withColumn("o_orderkey", F.lit(-1).cast("long"))
    return table_differences(o, materialize(copy.unionByName(extra), "orders_copy"), ["o_orderkey"])
