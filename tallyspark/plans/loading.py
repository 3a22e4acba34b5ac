"""File loading scenarios (SRC-1..5, CHG-9).

CSV: the customer table is exported as CSV by an upstream system that writes
negative balances in accounting style -- ``(994.28)`` -- which the declared
``decimal(12,2)`` column rejects.  Loading with ``on_error='continue'`` keeps
the other rows and hands the rejected lines out.

Incremental: the sales history is the target table; the staging batch (with
re-delivered rows) lands as several Parquet files, picked up by a Structured
Streaming ``availableNow`` run, two files per micro-batch, each merged
insert-only (new keys appended).  A second run finds no new files and leaves
the table as it is.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.plans.changes import HIST_SQL, MERGED_SQL, STAGE_SQL, history, staging
from tallyspark.plans.registry import query
from tallyspark.session import scratch_path
from tallyspark.sources.csv import CORRUPT, CsvFormat, read_table, write_csv
from tallyspark.sources.tables import Warehouse
from tallyspark.streaming.incremental import incremental_load
from tallyspark.streaming.partitioned import (
    BROKEN, ForeignKey, Rules, broken_rows, folder_width, key_range, load_with_constraints, write_partitioned)

CUSTOMER_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()),
    T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()),
    T.StructField("c_acctbal", T.DecimalType(12, 2)),
    T.StructField("c_mktsegment", T.StringType()),
])


def export_customers(spark: SparkSession, w: Warehouse) -> str:
    bal = F.col("c_acctbal").cast("decimal(12,2)")
    text = F.when(bal < 0, F.concat(F.lit("("), F.abs(bal).cast("string"), F.lit(")"))).otherwise(
        bal.cast("string"))
    out = w.customer.select(F.col("c_custkey").cast("string"), "c_name", F.col("c_nationkey").cast("string"),
                            text.alias("c_acctbal"), "c_mktsegment")
    return write_csv(out, scratch_path(spark, "customer_csv"))


def load_customers(spark: SparkSession, d: str, select=None):
    w = Warehouse(spark, d)
    path = export_customers(spark, w)
    return read_table(spark, path, CUSTOMER_SCHEMA, CsvFormat(), on_error="continue", select=select)


@query("csv_load_continue", """
SELECT c_custkey, c_name, c_nationkey, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE) AS c_acctbal, c_mktsegment
FROM customer WHERE CAST(c_acctbal AS DECIMAL(12,2)) >= 0
""")
def q_csv_load_continue(spark, d):
    """SRC-1/2/3: typed CSV scan, null tokens, bad rows skipped."""
    good, _ = load_customers(spark, d)
    return good.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@query("csv_load_rejects", """
SELECT c_custkey FROM customer WHERE CAST(c_acctbal AS DECIMAL(12,2)) < 0
""")
def q_csv_load_rejects(spark, d):
    """SRC-3: the rejected lines (raw text kept), keyed by their first field."""
    _, rejects = load_customers(spark, d)
    return rejects.select(F.split(F.col(CORRUPT), ",").getItem(0).cast("long").alias("c_custkey"))


@query("csv_load_transform", """
SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS membership,
       DATE '2026-01-01' AS effective_date, DATE '9999-12-31' AS expiry_date, TRUE AS is_current
FROM customer WHERE CAST(c_acctbal AS DECIMAL(12,2)) >= 0
""")
def q_csv_load_transform(spark, d):
    """SRC-5: load with a transformation -- selected fields, renamed, plus
    literal validity columns (type 2 initial load straight from the file)."""
    good, _ = load_customers(spark, d, select=[
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("membership"),
        F.lit(dt.date(2026, 1, 1)).alias("effective_date"), F.lit(dt.date(9999, 12, 31)).alias("expiry_date"),
        F.lit(True).alias("is_current")])
    return good


@query("incremental_load", MERGED_SQL)
def q_incremental_load(spark, d):
    """CHG-9: landing files -> availableNow stream -> per micro-batch, the new
    keys appended to the table.  Run twice; the second run adds nothing."""
    w = Warehouse(spark, d)
    landing = scratch_path(spark, "landing_sales")
    staging(w).repartition(4).write.parquet(landing)
    table = scratch_path(spark, "sales_table")
    history(w).write.parquet(table)
    ckpt = scratch_path(spark, "sales_stream_ckpt")
    schema = w.orders.schema
    incremental_load(spark, landing, schema, table, ["o_orderkey"], ckpt, max_files_per_batch=2)
    return incremental_load(spark, landing, schema, table, ["o_orderkey"], ckpt, max_files_per_batch=2)


@query("csv_null_tokens", """
SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE) END AS c_acctbal
FROM customer
""")
def q_csv_null_tokens(spark, d):
    """SRC-2, SRC-4: an export that writes missing segments as ``NULL`` and
    missing balances as an empty field, loaded with both tokens under the
    abort policy (no line is bad)."""
    c = Warehouse(spark, d).customer
    path = write_csv(c.select(
        F.col("c_custkey").cast("string"),
        F.when(F.col("c_custkey") % 7 == 0, "NULL").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(F.col("c_custkey") % 11 == 0, "").otherwise(
            F.col("c_acctbal").cast("decimal(12,2)").cast("string")).alias("c_acctbal")),
        scratch_path(spark, "customer_tokens_csv"))
    schema = T.StructType([CUSTOMER_SCHEMA[n] for n in ("c_custkey", "c_mktsegment", "c_acctbal")])
    good, _ = read_table(spark, path, schema, CsvFormat(null_tokens=("NULL", "")), on_error="abort")
    return good.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@query("csv_rejects_raw", """
SELECT CAST(c_custkey AS VARCHAR) || ',"' || c_name || ', Ltd",(' ||
       CAST(abs(CAST(c_acctbal AS DECIMAL(12,2))) AS VARCHAR) || ')' AS _corrupt_record
FROM customer WHERE CAST(c_acctbal AS DECIMAL(12,2)) < 0
""")
def q_csv_rejects_raw(spark, d):
    """SRC-3: rejected lines as they stand in the file, quotes included."""
    c = Warehouse(spark, d).customer
    bal = F.col("c_acctbal").cast("decimal(12,2)")
    path = write_csv(c.select(
        F.col("c_custkey").cast("string"), F.concat("c_name", F.lit(", Ltd")).alias("c_name"),
        F.when(bal < 0, F.concat(F.lit("("), F.abs(bal).cast("string"), F.lit(")"))).otherwise(
            bal.cast("string")).alias("c_acctbal")), scratch_path(spark, "customer_raw_csv"))
    schema = T.StructType([CUSTOMER_SCHEMA[n] for n in ("c_custkey", "c_name", "c_acctbal")])
    return read_table(spark, path, schema)[1]


@query("incremental_load_csv", f"""
WITH h AS (SELECT o_orderkey, o_custkey, o_orderpriority FROM ({HIST_SQL})),
s AS (SELECT DISTINCT o_orderkey, o_custkey, o_orderpriority FROM ({STAGE_SQL})
      WHERE o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0)
SELECT * FROM h UNION ALL SELECT * FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM h)
""")
def q_incremental_load_csv(spark, d):
    """CHG-9 from CSV files with lines that do not load (a key that is no
    number) and lines without a key: both go to the side folder.  Replayed from
    scratch after a lost checkpoint, the table stays the same."""
    w = Warehouse(spark, d)
    cols = ["o_orderkey", "o_custkey", "o_orderpriority"]
    key = F.col("o_orderkey").cast("string")
    text = (F.when(F.col("o_orderkey") % 13 == 0, F.concat(F.lit("K"), key))
            .when(F.col("o_orderkey") % 17 == 0, "null").otherwise(key))
    landing = write_csv(staging(w).select(cols).withColumn("o_orderkey", text).repartition(4),
                        scratch_path(spark, "landing_csv"))
    table = scratch_path(spark, "sales_csv_table")
    history(w).select(cols).write.parquet(table)
    for _ in range(2):  # the second run starts without the first one's checkpoint
        out = incremental_load(spark, landing, w.orders.select(cols).schema, table, ["o_orderkey"],
                               scratch_path(spark, "csv_stream_ckpt"), file_format="csv", max_files_per_batch=2)
    return out


def _address(name: str, segment: str):
    """A postal address as a source system keeps it: quotes, commas, line
    breaks and a blank line in one text."""
    return F.concat(F.col(name), F.lit(' "'), F.col(segment), F.lit('"\nUnit 5, Main Street\n\n""'), F.col(segment))


@query("csv_quoted_records", """
SELECT c_custkey, c_name || ' "' || c_mktsegment || '"' || chr(10) || 'Unit 5, Main Street' || chr(10) || chr(10) ||
       '""' || c_mktsegment AS address, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE) AS c_acctbal
FROM customer WHERE CAST(c_acctbal AS DECIMAL(12,2)) >= 0
""")
def q_csv_quoted_records(spark, d):
    """SRC-1: fields with doubled quotes, delimiters and line breaks; records
    that do not load (balances in accounting style) are set aside whole."""
    c = Warehouse(spark, d).customer
    bal = F.col("c_acctbal").cast("decimal(12,2)")
    path = write_csv(c.select(
        F.col("c_custkey").cast("string"), _address("c_name", "c_mktsegment").alias("address"),
        F.when(bal < 0, F.concat(F.lit("("), F.abs(bal).cast("string"), F.lit(")"))).otherwise(
            bal.cast("string")).alias("c_acctbal")), scratch_path(spark, "customer_quoted_csv"))
    schema = T.StructType([CUSTOMER_SCHEMA["c_custkey"], T.StructField("address", T.StringType()),
                           CUSTOMER_SCHEMA["c_acctbal"]])
    good, _ = read_table(spark, path, schema)
    return good.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@query("incremental_load_quoted", f"""
WITH h AS (SELECT o_orderkey, o_orderpriority FROM ({HIST_SQL})),
s AS (SELECT DISTINCT o_orderkey, o_orderpriority || ' "' || o_orderstatus || '"' || chr(10) || 'Unit 5, Main Street' ||
      chr(10) || chr(10) || '""' || o_orderstatus AS o_orderpriority FROM ({STAGE_SQL}))
SELECT * FROM h UNION ALL SELECT * FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM h)
""")
def q_incremental_load_quoted(spark, d):
    """CHG-9 with SRC-1: quoted records arriving as CSV files in a stream."""
    w = Warehouse(spark, d)
    cols = ["o_orderkey", "o_orderpriority"]
    landing = write_csv(staging(w).select(F.col("o_orderkey").cast("string"), _address(
        "o_orderpriority", "o_orderstatus").alias("o_orderpriority")).repartition(4),
        scratch_path(spark, "landing_quoted_csv"))
    table = scratch_path(spark, "sales_quoted_table")
    history(w).select(cols).write.parquet(table)
    return incremental_load(spark, landing, w.orders.select(cols).schema, table, ["o_orderkey"],
                            scratch_path(spark, "quoted_stream_ckpt"), file_format="csv", max_files_per_batch=2)


@query("incremental_load_partitioned", MERGED_SQL)
def q_incremental_load_partitioned(spark, d):
    """CHG-9 into a table in folders by key range: every micro-batch reads only
    the folders that its keys lie in.  Run twice, and once more without the
    first one's checkpoint."""
    w = Warehouse(spark, d)
    landing, path = scratch_path(spark, "landing_sales"), scratch_path(spark, "sales_by_range")
    staging(w).repartition(4).write.parquet(landing)
    part = key_range("o_orderkey", folder_width(w.orders, "o_orderkey", least=2000))
    write_partitioned(history(w), path, part)
    ckpt = scratch_path(spark, "sales_range_ckpt")
    for c in (ckpt, ckpt, scratch_path(spark, "sales_range_ckpt")):
        out = load_with_constraints(spark, landing, w.orders.schema, path, Rules(["o_orderkey"]), part, c,
                                    max_files_per_batch=2)
    return out


DEFECTS_SQL = f"""
WITH s AS (SELECT CASE WHEN o_orderkey % 103 = 0 THEN NULL ELSE o_orderkey END AS o_orderkey,
                  CASE WHEN o_orderkey % 101 = 0 THEN -1 ELSE o_custkey END AS o_custkey,
                  CASE WHEN o_orderkey % 107 = 0 THEN -o_totalprice ELSE o_totalprice END AS o_totalprice, o_orderdate
           FROM orders WHERE o_orderdate >= TIMESTAMP '1999-07-01 00:00:00'
           UNION ALL
           SELECT o_orderkey, o_custkey, o_totalprice + 1, o_orderdate FROM orders
           WHERE o_orderdate >= TIMESTAMP '2001-01-01 00:00:00' AND o_orderdate < TIMESTAMP '2001-02-01 00:00:00'),
k AS (SELECT o_orderkey FROM s WHERE o_orderkey IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1),
b AS (SELECT s.*, concat_ws(',', CASE WHEN o_orderkey IS NULL THEN 'missing key' END,
             CASE WHEN o_orderkey IN (SELECT o_orderkey FROM k) THEN 'duplicate key' END,
             CASE WHEN o_custkey NOT IN (SELECT c_custkey FROM customer) THEN 'unknown customer' END,
             CASE WHEN o_totalprice <= 0 THEN 'amount not positive' END) AS broken FROM s),
h AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM ({HIST_SQL}))
"""


def _defective_load(spark, d):
    """The staging batch with missing keys, unknown customers, negative amounts
    and orders of January 2001 delivered again with another amount."""
    w = Warehouse(spark, d)
    cols = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    o = w.orders.select(*cols).filter(day >= F.lit("1999-07-01 00:00:00").cast("timestamp"))
    first = o.select(F.when(key % 103 != 0, key).alias("o_orderkey"),
                     F.when(key % 101 == 0, F.lit(-1).cast("long")).otherwise(F.col("o_custkey")).alias("o_custkey"),
                     F.when(key % 107 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
                     "o_orderdate")
    again = o.filter((day >= F.lit("2001-01-01 00:00:00").cast("timestamp")) &
                     (day < F.lit("2001-02-01 00:00:00").cast("timestamp"))).withColumn(
        "o_totalprice", F.col("o_totalprice") + 1)
    landing, path = scratch_path(spark, "landing_defects"), scratch_path(spark, "sales_checked")
    first.unionByName(again).repartition(4).write.parquet(landing)
    part = key_range("o_orderkey", folder_width(w.orders, "o_orderkey", least=2000))
    write_partitioned(history(w).select(*cols), path, part)
    rules = Rules(["o_orderkey"], [ForeignKey("unknown customer", ["o_custkey"], w.customer, ["c_custkey"])],
                  {"amount not positive": F.col("o_totalprice") > 0})
    schema = w.orders.select(*cols).schema
    return load_with_constraints(spark, landing, schema, path, rules, part,
                                 scratch_path(spark, "sales_checked_ckpt")), broken_rows(spark, path, schema)


@query("load_with_constraints", DEFECTS_SQL + """
SELECT * FROM h UNION ALL SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM b
WHERE broken = '' AND o_orderkey NOT IN (SELECT o_orderkey FROM h)""")
def q_load_with_constraints(spark, d):
    """DQ-1/2 as rules of the load: only rows that meet all of them enter."""
    return _defective_load(spark, d)[0]


@query("load_broken_rows", DEFECTS_SQL + """
SELECT o_orderkey, o_custkey, o_totalprice, broken FROM b WHERE broken <> ''""")
def q_load_broken_rows(spark, d):
    """DQ-1/2: the offenders, each with every rule it breaks."""
    return _defective_load(spark, d)[1].select("o_orderkey", "o_custkey", "o_totalprice",
                                               F.array_join(BROKEN, ",").alias("broken"))
