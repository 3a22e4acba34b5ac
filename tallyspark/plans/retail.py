"""Sales reports (R1-R40) bound to the test tables.

orders plays the customer-side sale (amount o_totalprice, date o_orderdate,
status o_orderstatus); lineitem the product/branch-side sale line
(amount l_extendedprice, quantity l_quantity, product l_partkey, branch
l_suppkey); nation is the state, region the region.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.functions.columns import as_date, cents, full_name, money_sum, month_start, out_cents, out_money
from tallyspark.operators.ordered import continue_running_total, running_state, running_total
from tallyspark.operators.reports import (
    Lookup, Measure, above_average, best_per_group, money_m, order_desc,
    purchase_frequency, rank_by, revenue_by, top_by, with_global_avg)
from tallyspark.operators.sizing import hot_key_join, lookup_join
from tallyspark.operators.views import materialize, refresh_aggregate, unique_view_names
from tallyspark.plans.registry import ORACLE, cents_sql, money_sum_sql, query
from tallyspark.sources.tables import Warehouse

MS_ORDERS = money_sum_sql("o.o_totalprice")
MS_LINES = money_sum_sql("l.l_extendedprice")


def _w(spark: SparkSession, d: str) -> Warehouse:
    return Warehouse(spark, d)


def _customer_revenue(w: Warehouse) -> DataFrame:
    cust = w.customer.select("c_custkey", "c_name")
    return revenue_by(w.orders, ["c_custkey", "c_name"], [money_m("revenue", "o_totalprice")],
                      [Lookup(cust, "o_custkey", "c_custkey")])


def _part_revenue(w: Warehouse) -> DataFrame:
    part = w.part.select("p_partkey", "p_name", "p_type")
    return revenue_by(w.lineitem, ["p_partkey", "p_name", "p_type"],
                      [money_m("revenue", "l_extendedprice")],
                      [Lookup(part, "l_partkey", "p_partkey")])


def _supplier_revenue(w: Warehouse) -> DataFrame:
    sup = w.supplier.select("s_suppkey", "s_name")
    return revenue_by(w.lineitem, ["s_suppkey", "s_name"], [money_m("revenue", "l_extendedprice")],
                      [Lookup(sup, "l_suppkey", "s_suppkey")])


def _nation_region(w: Warehouse) -> DataFrame:
    """nation -> region flattened once.  25 rows by the TPC-H definition of
    nation (a fixed list), so broadcasting it is size-safe at any scale."""
    return F.broadcast(w.nation.join(F.broadcast(w.region), F.col("n_regionkey") == F.col("r_regionkey"))
                       .select("n_nationkey", "n_name", "r_regionkey", "r_name"))


# ---------------------------------------------------------------- R1-R14
CUST_SQL = f"""
SELECT c.c_custkey, c.c_name, {MS_ORDERS} AS revenue
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY c.c_custkey, c.c_name
"""


@query("revenue_by_customer", CUST_SQL)
def revenue_by_customer(spark, d):
    return _customer_revenue(_w(spark, d)).orderBy(*order_desc("revenue", "c_custkey"))


@query("revenue_by_customer_name", f"""
SELECT c.c_name, {MS_ORDERS} AS revenue
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY c.c_name
""")
def revenue_by_customer_name(spark, d):
    """Grouped by name only: customers sharing a name are merged (P2 form)."""
    w = _w(spark, d)
    cust = w.customer.select("c_custkey", "c_name")
    return (revenue_by(w.orders, ["c_name"], [money_m("revenue", "o_totalprice")],
                       [Lookup(cust, "o_custkey", "c_custkey")])
            .orderBy(*order_desc("revenue", "c_name")))


@query("revenue_by_segment", f"""
SELECT c.c_mktsegment, {MS_ORDERS} AS revenue
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY c.c_mktsegment
""")
def revenue_by_segment(spark, d):
    w = _w(spark, d)
    cust = w.customer.select("c_custkey", "c_mktsegment")
    return (revenue_by(w.orders, ["c_mktsegment"], [money_m("revenue", "o_totalprice")],
                       [Lookup(cust, "o_custkey", "c_custkey")])
            .orderBy(*order_desc("revenue", "c_mktsegment")))


@query("revenue_by_part", f"""
SELECT p.p_partkey, p.p_name, {MS_LINES} AS revenue
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY p.p_partkey, p.p_name
""")
def revenue_by_part(spark, d):
    w = _w(spark, d)
    part = w.part.select("p_partkey", "p_name")
    return (revenue_by(w.lineitem, ["p_partkey", "p_name"], [money_m("revenue", "l_extendedprice")],
                       [Lookup(part, "l_partkey", "p_partkey")])
            .orderBy(*order_desc("revenue", "p_partkey")))


@query("revenue_by_category", f"""
SELECT p.p_type, {MS_LINES} AS revenue
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY p.p_type
""")
def revenue_by_category(spark, d):
    w = _w(spark, d)
    part = w.part.select("p_partkey", "p_type")
    return (revenue_by(w.lineitem, ["p_type"], [money_m("revenue", "l_extendedprice")],
                       [Lookup(part, "l_partkey", "p_partkey")])
            .orderBy(*order_desc("revenue", "p_type")))


@query("revenue_by_brand", f"""
SELECT p.p_brand, {MS_LINES} AS revenue
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY p.p_brand
""")
def revenue_by_brand(spark, d):
    w = _w(spark, d)
    part = w.part.select("p_partkey", "p_brand")
    return (revenue_by(w.lineitem, ["p_brand"], [money_m("revenue", "l_extendedprice")],
                       [Lookup(part, "l_partkey", "p_partkey")])
            .orderBy(*order_desc("revenue", "p_brand")))


SUPP_SQL = f"""
SELECT s.s_suppkey, s.s_name, {MS_LINES} AS revenue
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
GROUP BY s.s_suppkey, s.s_name
"""


@query("revenue_by_supplier", SUPP_SQL)
def revenue_by_supplier(spark, d):
    return _supplier_revenue(_w(spark, d)).orderBy(*order_desc("revenue", "s_suppkey"))


@query("revenue_by_supplier_nation", f"""
SELECT n.n_name AS supplier_nation, {MS_LINES} AS revenue
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
GROUP BY n.n_name
""")
def revenue_by_supplier_nation(spark, d):
    """Hierarchy chain line -> branch -> state."""
    w = _w(spark, d)
    sup = w.supplier.select("s_suppkey", "s_nationkey")
    nat = F.broadcast(w.nation.select("n_nationkey", F.col("n_name").alias("supplier_nation")))
    return (revenue_by(w.lineitem, ["supplier_nation"], [money_m("revenue", "l_extendedprice")],
                       [Lookup(sup, "l_suppkey", "s_suppkey"),
                        Lookup(nat, "s_nationkey", "n_nationkey", small=True)])
            .orderBy(*order_desc("revenue", "supplier_nation")))


@query("revenue_by_region", f"""
SELECT r.r_name, {MS_LINES} AS revenue
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY r.r_name
""")
def revenue_by_region(spark, d):
    """Chain line -> branch -> state -> region; the state/region levels are
    flattened once (25 rows) and joined as one look-up."""
    w = _w(spark, d)
    sup = w.supplier.select("s_suppkey", "s_nationkey")
    geo = _nation_region(w).select("n_nationkey", "r_name")
    return (revenue_by(w.lineitem, ["r_name"], [money_m("revenue", "l_extendedprice")],
                       [Lookup(sup, "l_suppkey", "s_suppkey"), Lookup(geo, "s_nationkey", "n_nationkey", small=True)])
            .orderBy(*order_desc("revenue", "r_name")))


@query("revenue_by_customer_nation", f"""
SELECT n.n_name AS customer_nation, {MS_ORDERS} AS revenue
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name
""")
def revenue_by_customer_nation(spark, d):
    w = _w(spark, d)
    cust = w.customer.select("c_custkey", "c_nationkey")
    nat = F.broadcast(w.nation.select("n_nationkey", F.col("n_name").alias("customer_nation")))
    return (revenue_by(w.orders, ["customer_nation"], [money_m("revenue", "o_totalprice")],
                       [Lookup(cust, "o_custkey", "c_custkey"),
                        Lookup(nat, "c_nationkey", "n_nationkey", small=True)])
            .orderBy(*order_desc("revenue", "customer_nation")))


@query("revenue_by_status", f"""
SELECT o.o_orderstatus AS order_status, {MS_ORDERS} AS revenue
FROM orders o GROUP BY o.o_orderstatus
""")
def revenue_by_status(spark, d):
    w = _w(spark, d)
    o = w.orders.select(F.col("o_orderstatus").alias("order_status"), "o_totalprice")
    return (revenue_by(o, ["order_status"], [money_m("revenue", "o_totalprice")])
            .orderBy(*order_desc("revenue", "order_status")))


@query("revenue_by_month", f"""
SELECT CAST(date_trunc('month', o.o_orderdate) AS DATE) AS sales_month, {MS_ORDERS} AS revenue
FROM orders o GROUP BY 1
""")
def revenue_by_month(spark, d):
    o = _w(spark, d).orders.select(month_start("o_orderdate").alias("sales_month"), "o_totalprice")
    return revenue_by(o, ["sales_month"], [money_m("revenue", "o_totalprice")]).orderBy("sales_month")


@query("revenue_by_quarter", f"""
SELECT CAST(year(o.o_orderdate) AS INTEGER) AS sales_year,
       'Q' || CAST(quarter(o.o_orderdate) AS VARCHAR) AS sales_quarter,
       {MS_ORDERS} AS revenue
FROM orders o GROUP BY 1, 2
""")
def revenue_by_quarter(spark, d):
    o = _w(spark, d).orders.select(
        F.year("o_orderdate").cast("int").alias("sales_year"),
        F.concat(F.lit("Q"), F.quarter("o_orderdate").cast("string")).alias("sales_quarter"),
        "o_totalprice")
    return (revenue_by(o, ["sales_year", "sales_quarter"], [money_m("revenue", "o_totalprice")])
            .orderBy("sales_year", "sales_quarter"))


@query("revenue_by_day", f"""
SELECT CAST(o.o_orderdate AS DATE) AS sale_date, {MS_ORDERS} AS revenue
FROM orders o GROUP BY 1
""")
def revenue_by_day(spark, d):
    o = _w(spark, d).orders.select(as_date("o_orderdate").alias("sale_date"), "o_totalprice")
    return revenue_by(o, ["sale_date"], [money_m("revenue", "o_totalprice")]).orderBy("sale_date")


@query("total_revenue", f"""
SELECT {MS_ORDERS} AS total_revenue, CAST(COUNT(*) AS BIGINT) AS order_count FROM orders o
""")
def total_revenue(spark, d):
    o = _w(spark, d).orders
    # a one-row total over the whole fact: exact decimal sum (no bound needed)
    return o.agg(money_sum("o_totalprice").alias("total_revenue"),
                 F.count(F.lit(1)).alias("order_count")).select(
        out_money("total_revenue").alias("total_revenue"),
        F.col("order_count").cast("long").alias("order_count"))


@query("supplier_performance", f"""
SELECT s.s_suppkey, s.s_name, {MS_LINES} AS revenue,
       CAST(SUM(CAST(l.l_quantity AS BIGINT)) AS BIGINT) AS total_quantity
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
GROUP BY s.s_suppkey, s.s_name
""")
def supplier_performance(spark, d):
    """R4 branch performance: revenue and quantity in one pass."""
    w = _w(spark, d)
    li = w.lineitem.withColumn("qty", F.col("l_quantity").cast("long"))
    sup = w.supplier.select("s_suppkey", "s_name")
    return (revenue_by(li, ["s_suppkey", "s_name"],
                       [money_m("revenue", "l_extendedprice"), Measure("total_quantity", "sum", "qty")],
                       [Lookup(sup, "l_suppkey", "s_suppkey")])
            .withColumn("total_quantity", F.col("total_quantity").cast("long"))
            .orderBy(*order_desc("revenue", "s_suppkey")))


# ---------------------------------------------------------------- R15-R22
@query("top1_customer", f"""
SELECT * FROM ({CUST_SQL}) ORDER BY revenue DESC NULLS LAST, c_custkey LIMIT 1
""")
def top1_customer(spark, d):
    return top_by(_customer_revenue(_w(spark, d)), "revenue", ["c_custkey"], 1)


@query("top1_supplier", f"""
SELECT * FROM ({SUPP_SQL}) ORDER BY revenue DESC NULLS LAST, s_suppkey LIMIT 1
""")
def top1_supplier(spark, d):
    return top_by(_supplier_revenue(_w(spark, d)), "revenue", ["s_suppkey"], 1)


@query("top3_customers_numbered", f"""
SELECT *, CAST(row_number() OVER (ORDER BY revenue DESC NULLS LAST, c_custkey) AS INTEGER) AS row_num
FROM ({CUST_SQL}) ORDER BY revenue DESC NULLS LAST, c_custkey LIMIT 3
""")
def top3_customers_numbered(spark, d):
    return top_by(_customer_revenue(_w(spark, d)), "revenue", ["c_custkey"], 3, numbered="row_num")


@query("top5_customers", f"""
SELECT * FROM ({CUST_SQL}) ORDER BY revenue DESC NULLS LAST, c_custkey LIMIT 5
""")
def top5_customers(spark, d):
    return top_by(_customer_revenue(_w(spark, d)), "revenue", ["c_custkey"], 5)


@query("top5_parts", f"""
SELECT p.p_partkey, p.p_name, {MS_LINES} AS revenue
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY p.p_partkey, p.p_name ORDER BY revenue DESC NULLS LAST, p_partkey LIMIT 5
""")
def top5_parts(spark, d):
    return top_by(_part_revenue(_w(spark, d)).drop("p_type"), "revenue", ["p_partkey"], 5)


@query("top10_suppliers", f"""
SELECT * FROM ({SUPP_SQL}) ORDER BY revenue DESC NULLS LAST, s_suppkey LIMIT 10
""")
def top10_suppliers(spark, d):
    return top_by(_supplier_revenue(_w(spark, d)), "revenue", ["s_suppkey"], 10)


@query("customer_rank", f"""
SELECT *, CAST(rank() OVER (ORDER BY revenue DESC NULLS LAST) AS BIGINT) AS revenue_rank
FROM ({CUST_SQL})
""")
def customer_rank(spark, d):
    return rank_by(_customer_revenue(_w(spark, d)), "revenue", "revenue_rank")


@query("supplier_rank", f"""
SELECT *, CAST(rank() OVER (ORDER BY revenue DESC NULLS LAST) AS BIGINT) AS revenue_rank
FROM ({SUPP_SQL})
""")
def supplier_rank(spark, d):
    return rank_by(_supplier_revenue(_w(spark, d)), "revenue", "revenue_rank")


@query("part_rank", f"""
SELECT p.p_partkey, p.p_name, {MS_LINES} AS revenue,
       CAST(rank() OVER (ORDER BY {MS_LINES} DESC NULLS LAST) AS BIGINT) AS revenue_rank
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY p.p_partkey, p.p_name
""")
def part_rank(spark, d):
    return rank_by(_part_revenue(_w(spark, d)).drop("p_type"), "revenue", "revenue_rank")


@query("best_part_per_type", f"""
SELECT p_type, p_partkey, p_name, revenue FROM (
  SELECT p.p_type, p.p_partkey, p.p_name, {MS_LINES} AS revenue,
         row_number() OVER (PARTITION BY p.p_type ORDER BY {MS_LINES} DESC NULLS LAST, p.p_partkey) AS rn
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY p.p_type, p.p_partkey, p.p_name)
WHERE rn = 1
""")
def best_part_per_type(spark, d):
    """Best-selling product per category."""
    grouped = _part_revenue(_w(spark, d))
    return (best_per_group(grouped, ["p_type"], "revenue", ["p_partkey"])
            .select("p_type", "p_partkey", "p_name", "revenue").orderBy("p_type"))


# ---------------------------------------------------------------- R23-R25
@query("running_by_order", f"""
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS amount,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) OVER (
            ORDER BY CAST(o_orderdate AS DATE), o_orderkey
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_revenue
FROM orders
""")
def running_by_order(spark, d):
    """Running revenue per sale in (date, sale id) order, distributed."""
    o = _w(spark, d).orders.select(
        "o_orderkey", "o_custkey", as_date("o_orderdate").alias("order_date"),
        cents("o_totalprice").alias("amount_cents"))
    run = running_total(o, ["order_date", "o_orderkey"], "amount_cents", "running_cents")
    return run.select("o_orderkey", "o_custkey", "order_date",
                      out_cents("amount_cents").alias("amount"),
                      out_cents("running_cents").alias("running_revenue"))


@query("running_by_day", f"""
SELECT sale_date, revenue,
       CAST(SUM(rev_dec) OVER (ORDER BY sale_date) AS DOUBLE) AS running_revenue
FROM (SELECT CAST(o_orderdate AS DATE) AS sale_date,
             SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS rev_dec,
             CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS revenue
      FROM orders GROUP BY 1)
""")
def running_by_day(spark, d):
    """Running total of daily revenue, default RANGE frame.  The window
    runs over the daily series: one row per calendar day in the data, a size
    bounded by the date range, not by the number of sales."""
    o = _w(spark, d).orders.select(as_date("o_orderdate").alias("sale_date"),
                                   cents("o_totalprice").alias("c"))
    daily = o.groupBy("sale_date").agg(F.sum("c").alias("day_cents"))
    w = Window.orderBy("sale_date").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select("sale_date", out_cents("day_cents").alias("revenue"),
                        out_cents(F.sum("day_cents").over(w)).alias("running_revenue")).orderBy("sale_date")


@query("order_vs_average", f"""
SELECT o_orderkey, o_custkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS amount,
       (SELECT ((SUM({cents_sql('o_totalprice')}) * 2 + COUNT(*)) // (COUNT(*) * 2)) / 100.0 FROM orders)
         AS average_amount
FROM orders
""")
def order_vs_average(spark, d):
    """Each sale beside the overall average (a one-row aggregate inlined
    as a scalar subquery)."""
    o = _w(spark, d).orders.select("o_orderkey", "o_custkey", cents("o_totalprice").alias("amount_cents"))
    return (with_global_avg(o, "amount_cents", "average_amount")
            .select("o_orderkey", "o_custkey", out_cents("amount_cents").alias("amount"), "average_amount"))


# ---------------------------------------------------------------- R26-R35
@query("purchase_frequency_all", """
SELECT c.c_custkey, c.c_name, CAST(COALESCE(u.order_count, 0) AS BIGINT) AS order_count
FROM customer c LEFT JOIN (
  SELECT o_custkey, COUNT(o_orderkey) AS order_count FROM orders GROUP BY o_custkey) u ON c.c_custkey = u.o_custkey
""")
def purchase_frequency_all(spark, d):
    """Orders per customer; customers without one appear with 0."""
    w = _w(spark, d)
    return purchase_frequency(w.customer.select("c_custkey", "c_name"), w.orders, "c_custkey",
                              "o_custkey", "o_orderkey", "order_count", keep_zero=True
                              ).orderBy(F.col("order_count").desc(), "c_custkey")


@query("purchase_frequency_inner", """
SELECT c.c_custkey, c.c_name, CAST(COUNT(o.o_orderkey) AS BIGINT) AS order_count
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY c.c_custkey, c.c_name
""")
def purchase_frequency_inner(spark, d):
    """Inner-join form: customers without an order drop out."""
    w = _w(spark, d)
    return purchase_frequency(w.customer.select("c_custkey", "c_name"), w.orders, "c_custkey",
                              "o_custkey", "o_orderkey", "order_count", keep_zero=False
                              ).withColumn("order_count", F.col("order_count").cast("long"))


@query("purchase_analysis", f"""
SELECT c.c_custkey, c.c_name, CAST(COUNT(o.o_orderkey) AS BIGINT) AS order_count,
       CAST(SUM(COALESCE(q.qty, 0)) AS BIGINT) AS total_quantity,
       {MS_ORDERS} AS total_spending
FROM orders o
LEFT JOIN (SELECT l_orderkey, SUM(CAST(l_quantity AS BIGINT)) AS qty FROM lineitem GROUP BY l_orderkey) q
  ON q.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY c.c_custkey, c.c_name
""")
def purchase_analysis(spark, d):
    """Per customer -- orders, items bought, spending.  Lines are summed
    per order first (lineitem is clustered by order, so the partial aggregate
    shrinks it ~4x before its shuffle); the order-level join is co-partitioned
    on the order key; customers are joined after the per-customer aggregate
    (broadcast only when proven small, ``lookup_join``)."""
    w = _w(spark, d)
    qty = (w.lineitem.groupBy("l_orderkey")
           .agg(F.sum(F.col("l_quantity").cast("long")).alias("qty")))
    orders = w.orders
    o = orders.join(qty, orders["o_orderkey"] == qty["l_orderkey"], "left")
    per_cust = o.groupBy("o_custkey").agg(
        F.count("o_orderkey").alias("order_count"),
        F.sum(F.coalesce(F.col("qty"), F.lit(0))).alias("total_quantity"),
        money_m("total_spending", "o_totalprice").partial())
    cust = w.customer.select("c_custkey", "c_name")
    return (lookup_join(per_cust, cust, per_cust["o_custkey"] == cust["c_custkey"])
            .select("c_custkey", "c_name", F.col("order_count").cast("long").alias("order_count"),
                    F.col("total_quantity").cast("long").alias("total_quantity"),
                    out_cents("total_spending").alias("total_spending"))
            .orderBy(*order_desc("total_spending", "c_custkey")))


PART_QTY_REV_SQL = f"""
SELECT p.p_partkey, p.p_name, CAST(SUM(CAST(l.l_quantity AS BIGINT)) AS BIGINT) AS total_quantity,
       {MS_LINES} AS revenue
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY p.p_partkey, p.p_name
"""


def _part_qty_rev(w: Warehouse, with_revenue: bool) -> DataFrame:
    li = w.lineitem.withColumn("qty", F.col("l_quantity").cast("long"))
    part = w.part.select("p_partkey", "p_name")
    ms = [Measure("total_quantity", "sum", "qty")]
    if with_revenue:
        ms.append(money_m("revenue", "l_extendedprice"))
    return (revenue_by(li, ["p_partkey", "p_name"], ms, [Lookup(part, "l_partkey", "p_partkey")])
            .withColumn("total_quantity", F.col("total_quantity").cast("long")))


@query("quantity_by_part", """
SELECT p.p_partkey, p.p_name, CAST(SUM(CAST(l.l_quantity AS BIGINT)) AS BIGINT) AS total_quantity
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY p.p_partkey, p.p_name
""")
def quantity_by_part(spark, d):
    """R28."""
    return _part_qty_rev(_w(spark, d), False).orderBy(*order_desc("total_quantity", "p_partkey"))


@query("part_dashboard", PART_QTY_REV_SQL)
def part_dashboard(spark, d):
    """Quantity and revenue per product in one pass."""
    return _part_qty_rev(_w(spark, d), True).orderBy(*order_desc("revenue", "p_partkey"))


@query("region_dashboard", f"""
SELECT r.r_name, CAST(SUM(CAST(l.l_quantity AS BIGINT)) AS BIGINT) AS total_quantity, {MS_LINES} AS revenue
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY r.r_name
""")
def region_dashboard(spark, d):
    """Quantity and revenue per region via the branch hierarchy."""
    w = _w(spark, d)
    li = w.lineitem.withColumn("qty", F.col("l_quantity").cast("long"))
    sup = w.supplier.select("s_suppkey", "s_nationkey")
    geo = _nation_region(w).select("n_nationkey", "r_name")
    return (revenue_by(li, ["r_name"], [Measure("total_quantity", "sum", "qty"),
                                        money_m("revenue", "l_extendedprice")],
                       [Lookup(sup, "l_suppkey", "s_suppkey"), Lookup(geo, "s_nationkey", "n_nationkey", small=True)])
            .withColumn("total_quantity", F.col("total_quantity").cast("long"))
            .orderBy(*order_desc("revenue", "r_name")))


@query("customer_day_trend", f"""
SELECT c.c_custkey, c.c_name, CAST(o.o_orderdate AS DATE) AS sale_date, {MS_ORDERS} AS revenue
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY c.c_custkey, c.c_name, CAST(o.o_orderdate AS DATE)
""")
def customer_day_trend(spark, d):
    """Customer x date revenue (star join fact + customer + date)."""
    w = _w(spark, d)
    o = w.orders.select("o_custkey", as_date("o_orderdate").alias("sale_date"), "o_totalprice")
    cust = w.customer.select("c_custkey", "c_name")
    return (revenue_by(o, ["c_custkey", "c_name", "sale_date"], [money_m("revenue", "o_totalprice")],
                       [Lookup(cust, "o_custkey", "c_custkey")])
            .orderBy("c_custkey", "sale_date"))


@query("revenue_cte", CUST_SQL)
def revenue_cte(spark, d):
    """The customer revenue report written as a CTE through Spark SQL."""
    w = _w(spark, d)
    v = unique_view_names(spark, {"orders": w.orders, "customer": w.customer})
    return spark.sql(f"""
        WITH order_revenue AS (
          SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS rev
          FROM {v['orders']} GROUP BY o_custkey)
        SELECT c.c_custkey, c.c_name, CAST(SUM(r.rev) AS DOUBLE) AS revenue
        FROM order_revenue r JOIN {v['customer']} c ON r.o_custkey = c.c_custkey
        GROUP BY c.c_custkey, c.c_name
        ORDER BY revenue DESC NULLS LAST, c.c_custkey""")


ABOVE_AVG_SQL = f"""
WITH cr AS ({CUST_SQL.replace(MS_ORDERS, 'SUM(' + cents_sql('o.o_totalprice') + ') AS revenue_cents, ' + MS_ORDERS)})
SELECT c_custkey, c_name, revenue FROM cr
WHERE revenue_cents * (SELECT COUNT(*) FROM cr) > (SELECT SUM(revenue_cents) FROM cr)
"""


@query("above_average_crossjoin", ABOVE_AVG_SQL)
def above_average_crossjoin(spark, d):
    """R33 (chained-CTE form): customers whose revenue beats the average
    customer revenue; the one-row total and count are a scalar subquery
    computed once, so the reference's cross join needs no join at all."""
    w = _w(spark, d)
    cust = w.customer.select("c_custkey", "c_name")
    o = w.orders.select("o_custkey", "o_totalprice", cents("o_totalprice").alias("oc"))
    cr = revenue_by(o, ["c_custkey", "c_name"],
                    [money_m("revenue", "o_totalprice"), Measure("revenue_cents", "sum", "oc")],
                    [Lookup(cust, "o_custkey", "c_custkey")])
    return (above_average(cr, "revenue_cents").select("c_custkey", "c_name", "revenue")
            .orderBy(*order_desc("revenue", "c_custkey")))


@query("above_average_subquery", ABOVE_AVG_SQL)
def above_average_subquery(spark, d):
    """R33 (scalar-subquery form) through Spark SQL.  Sales are summed per key
    before the join, so a customer with very many sales is reduced inside each
    task; the frame is read by three plan branches and AQE reuses the exchange."""
    w = _w(spark, d)
    v = unique_view_names(spark, {"orders": w.orders, "customer": w.customer})
    return spark.sql(f"""
        WITH per_key AS (
          SELECT o_custkey, SUM(CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 100 AS BIGINT)) AS revenue_cents
          FROM {v['orders']} GROUP BY o_custkey),
        cr AS (
          SELECT c.c_custkey, c.c_name, p.revenue_cents
          FROM per_key p JOIN {v['customer']} c ON p.o_custkey = c.c_custkey)
        SELECT c_custkey, c_name, revenue_cents / CAST(100 AS DOUBLE) AS revenue FROM cr
        WHERE CAST(revenue_cents AS DECIMAL(19,0)) * (SELECT CAST(COUNT(*) AS DECIMAL(18,0)) FROM cr)
              > (SELECT CAST(SUM(revenue_cents) AS DECIMAL(38,0)) FROM cr)
        ORDER BY revenue DESC NULLS LAST, c_custkey""")


@query("filter_status", """
SELECT o.o_orderkey, c.c_name AS customer_name, o.o_orderstatus AS order_status,
       CAST(CAST(o.o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS amount
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE o.o_orderstatus = 'F'
""")
def filter_status(spark, d):
    """Fulfilled ('delivered') orders; the equality filter reaches the scan."""
    w = _w(spark, d)
    o = w.orders.filter(F.col("o_orderstatus") == "F")
    cust = w.customer.select("c_custkey", "c_name")
    return (lookup_join(o, cust, o["o_custkey"] == cust["c_custkey"])
            .select("o_orderkey", F.col("c_name").alias("customer_name"),
                    F.col("o_orderstatus").alias("order_status"),
                    F.col("o_totalprice").cast("decimal(12,2)").cast("double").alias("amount"))
            .orderBy("o_orderkey"))


@query("customer_labels", """
SELECT c_custkey, concat(c_name, ' ', c_mktsegment) AS label FROM customer
""")
def customer_labels(spark, d):
    """FN-1: two attributes joined by a blank."""
    return _w(spark, d).customer.select("c_custkey", full_name("c_name", "c_mktsegment").alias("label"))


@query("orders_after_timestamp", """
SELECT o.o_orderkey, c.c_name AS customer_name, o.o_orderdate AS order_ts,
       CAST(CAST(o.o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS amount
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE o.o_orderdate > TIMESTAMP '2000-06-30 00:00:00'
""")
def orders_after_timestamp(spark, d):
    """Orders after a point in time (range filter pushed to Parquet)."""
    w = _w(spark, d)
    o = w.orders.filter(F.col("o_orderdate") > F.lit("2000-06-30 00:00:00").cast("timestamp"))
    cust = w.customer.select("c_custkey", "c_name")
    return (lookup_join(o, cust, o["o_custkey"] == cust["c_custkey"])
            .select("o_orderkey", F.col("c_name").alias("customer_name"),
                    F.col("o_orderdate").alias("order_ts"),
                    F.col("o_totalprice").cast("decimal(12,2)").cast("double").alias("amount"))
            .orderBy("order_ts", "o_orderkey"))


# ---------------------------------------------------------------- R36-R40
WIDE_SQL = """
SELECT l.l_orderkey, l.l_linenumber, CAST(o.o_orderdate AS DATE) AS sale_date,
       c.c_custkey, c.c_name AS customer_name, cn.n_name AS customer_nation,
       p.p_partkey, p.p_name AS product_name, p.p_type AS category, p.p_brand AS brand,
       s.s_suppkey, s.s_name AS branch_name, sn.n_name AS branch_nation,
       CAST(l.l_quantity AS BIGINT) AS quantity,
       CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS amount
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation cn ON c.c_nationkey = cn.n_nationkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation sn ON s.s_nationkey = sn.n_nationkey
"""


def wide_sales(w: Warehouse) -> DataFrame:
    """15-column sales report; same-named attributes from two sides
    (customer nation vs branch nation) are disambiguated by aliasing.

    Join order for scale: customer attributes are attached to the orders first
    and nation names to the branches first (order- and branch-sized data), so
    the line-sized rows meet one join per remaining key (order, product,
    branch) instead of one more for the customer key.  Lines and orders are
    both fact-sized: sort-merge join on the order key.  Product and branch
    are broadcast only when their size is proven (``lookup_join``); beyond the
    bound the lines are shuffled once per key for a sort-merge join."""
    cn = F.broadcast(w.nation.select(F.col("n_nationkey").alias("cn_key"),
                                     F.col("n_name").alias("customer_nation")))
    sn = F.broadcast(w.nation.select(F.col("n_nationkey").alias("sn_key"),
                                     F.col("n_name").alias("branch_nation")))
    c = w.customer.select("c_custkey", "c_name", "c_nationkey")
    orders = (lookup_join(w.orders, c, F.col("o_custkey") == F.col("c_custkey"))
              .join(cn, F.col("c_nationkey") == F.col("cn_key"))
              .select("o_orderkey", as_date("o_orderdate").alias("sale_date"), "c_custkey",
                      F.col("c_name").alias("customer_name"), "customer_nation"))
    branches = (w.supplier.join(sn, F.col("s_nationkey") == F.col("sn_key"))
                .select("s_suppkey", F.col("s_name").alias("branch_name"), "branch_nation"))
    products = w.part.select("p_partkey", F.col("p_name").alias("product_name"),
                             F.col("p_type").alias("category"), F.col("p_brand").alias("brand"))
    li = w.lineitem
    # orders are the other half of the fact (a quarter of the lines at any
    # scale), not a look-up: a sort-merge join on the order key
    j = lookup_join(li, orders, F.col("l_orderkey") == F.col("o_orderkey"), known_small=False)
    j = lookup_join(j, products, F.col("l_partkey") == F.col("p_partkey"))
    j = lookup_join(j, branches, F.col("l_suppkey") == F.col("s_suppkey"))
    return (j.select("l_orderkey", "l_linenumber", "sale_date", "c_custkey", "customer_name",
                    "customer_nation", "p_partkey", "product_name", "category", "brand",
                    "s_suppkey", "branch_name", "branch_nation",
                    F.col("l_quantity").cast("long").alias("quantity"),
                    F.col("l_extendedprice").cast("decimal(12,2)").cast("double").alias("amount")))


@query("wide_sales_view", WIDE_SQL)
def wide_sales_view(spark, d):
    w = _w(spark, d)
    v = unique_view_names(spark, {"wide_sales": wide_sales(w)})
    return spark.table(v["wide_sales"])


@query("customer_revenue_view", CUST_SQL)
def customer_revenue_view(spark, d):
    """The customer revenue report as a named view, read back (the view is
    re-evaluated on each read; filters on it are pushed through)."""
    v = unique_view_names(spark, {"customer_revenue": _customer_revenue(_w(spark, d))})
    return spark.table(v["customer_revenue"])


@query("part_revenue_view", f"""
SELECT p.p_partkey, p.p_name, p.p_type, {MS_LINES} AS revenue
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY p.p_partkey, p.p_name, p.p_type
""")
def part_revenue_view(spark, d):
    """R38."""
    v = unique_view_names(spark, {"part_revenue": _part_revenue(_w(spark, d))})
    return spark.table(v["part_revenue"])


@query("supplier_revenue_view", SUPP_SQL)
def supplier_revenue_view(spark, d):
    """R39 (view form): branch revenue as a named view, read back."""
    v = unique_view_names(spark, {"supplier_revenue": _supplier_revenue(_w(spark, d))})
    return spark.table(v["supplier_revenue"])


@query("materialized_supplier_revenue", SUPP_SQL)
def materialized_supplier_revenue(spark, d):
    """R39 / VIW-2: revenue per branch stored as a table from the lines shipped
    before 2000-01-01, then refreshed with the later lines.  sum is mergeable,
    so stored part + delta part = full aggregate."""
    w = _w(spark, d)
    sup = w.supplier.select("s_suppkey", "s_name")
    cutoff = F.lit("2000-01-01 00:00:00").cast("timestamp")

    def agg(lines):
        return revenue_by(lines, ["s_suppkey", "s_name"], [Measure("revenue_dec", "sum", "amt")],
                          [Lookup(sup, "l_suppkey", "s_suppkey")])

    li = w.lineitem.withColumn("amt", F.col("l_extendedprice").cast("decimal(12,2)"))
    stored = materialize(agg(li.filter(F.col("l_shipdate") < cutoff)), "supplier_revenue")
    delta = agg(li.filter(F.col("l_shipdate") >= cutoff))
    refreshed = refresh_aggregate(stored, delta, ["s_suppkey", "s_name"], ["revenue_dec"], "supplier_revenue")
    return refreshed.select("s_suppkey", "s_name", F.col("revenue_dec").cast("double").alias("revenue"))


@query("top_customers_materialized", f"""
SELECT t.c_custkey, c.c_name, t.revenue FROM (
  SELECT o_custkey AS c_custkey, {money_sum_sql('o_totalprice')} AS revenue FROM orders GROUP BY o_custkey
  ORDER BY revenue DESC NULLS LAST, c_custkey LIMIT 10) t
JOIN customer c ON t.c_custkey = c.c_custkey
""")
def top_customers_materialized(spark, d):
    """Stored top-10 customer aggregate joined back to the customer table."""
    w = _w(spark, d)
    per_cust = (w.orders.groupBy(F.col("o_custkey").alias("c_custkey"))
                .agg(F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("double").alias("revenue")))
    stored = materialize(top_by(per_cust, "revenue", ["c_custkey"], 10), "top_customers")
    cust = w.customer.select("c_custkey", "c_name")
    return (stored.join(cust, "c_custkey").select("c_custkey", "c_name", "revenue")
            .orderBy(*order_desc("revenue", "c_custkey")))


@query("reconcile_totals", f"""
SELECT 'global' AS report, {money_sum_sql('o_totalprice')} AS total FROM orders
UNION ALL SELECT 'by_customer', CAST(SUM(rev) AS DOUBLE) FROM (
  SELECT SUM(CAST(o.o_totalprice AS DECIMAL(12,2))) AS rev FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY c.c_custkey)
UNION ALL SELECT 'by_status', CAST(SUM(rev) AS DOUBLE) FROM (
  SELECT SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS rev FROM orders GROUP BY o_orderstatus)
UNION ALL SELECT 'by_month', CAST(SUM(rev) AS DOUBLE) FROM (
  SELECT SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS rev FROM orders GROUP BY date_trunc('month', o_orderdate))
""")
def reconcile_totals(spark, d):
    """DQ-8 (grouped vs global): the totals of the grouped reports equal the
    global total.  Each grouped report keeps its exact decimal sums so the
    comparison is exact."""
    w = _w(spark, d)
    o = w.orders.select("o_custkey", "o_orderstatus", month_start("o_orderdate").alias("m"),
                        F.col("o_totalprice").cast("decimal(12,2)").alias("amt"))
    cust = w.customer.select("c_custkey")
    by = {
        "by_customer": revenue_by(o, ["c_custkey"], [Measure("rev", "sum", "amt")],
                                  [Lookup(cust, "o_custkey", "c_custkey")]),
        "by_status": revenue_by(o, ["o_orderstatus"], [Measure("rev", "sum", "amt")]),
        "by_month": revenue_by(o, ["m"], [Measure("rev", "sum", "amt")]),
    }
    parts = [o.agg(F.sum("amt").cast("double").alias("total")).select(F.lit("global").alias("report"), "total")]
    parts += [g.agg(F.sum("rev").cast("double").alias("total")).select(F.lit(n).alias("report"), "total")
              for n, g in by.items()]
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


@query("running_by_order_continued", ORACLE["running_by_order"])
def running_by_order_continued(spark, d):
    """WIN-4 loaded in two parts: sales before 2000 are summed and stored with
    the state they end in; the later ones are summed from that state alone."""
    o = _w(spark, d).orders.select("o_orderkey", "o_custkey", as_date("o_orderdate").alias("order_date"),
                                   cents("o_totalprice").alias("amount_cents"))
    order, cut = ["order_date", "o_orderkey"], F.lit("2000-01-01").cast("date")
    first = materialize(running_total(o.filter(F.col("order_date") < cut), order, "amount_cents", "running_cents"),
                        "running_first")
    state = materialize(running_state(first, order, "running_cents"), "running_state")
    later = continue_running_total(state, o.filter(F.col("order_date") >= cut), order, "amount_cents", "running_cents")
    return first.unionByName(later).select(
        "o_orderkey", "o_custkey", "order_date", out_cents("amount_cents").alias("amount"),
        out_cents("running_cents").alias("running_revenue"))


@query("running_by_day_continued", ORACLE["running_by_day"])
def running_by_day_continued(spark, d):
    """WIN-5 likewise: the days before 2000 are stored with their last total."""
    daily = _w(spark, d).orders.groupBy(as_date("o_orderdate").alias("sale_date")).agg(
        F.sum(cents("o_totalprice")).alias("day_cents"))
    daily, cut = materialize(daily, "daily_sales"), F.lit("2000-01-01").cast("date")
    first = materialize(running_total(daily.filter(F.col("sale_date") < cut), ["sale_date"], "day_cents", "running_cents"),
                        "running_days")
    state = materialize(running_state(first, ["sale_date"], "running_cents"), "running_state")
    later = continue_running_total(state, daily.filter(F.col("sale_date") >= cut), ["sale_date"], "day_cents",
                                   "running_cents")
    return first.unionByName(later).select("sale_date", out_cents("day_cents").alias("revenue"),
                                           out_cents("running_cents").alias("running_revenue"))


@query("hot_customer_join", f"""
WITH s AS (SELECT CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE o_custkey END AS o_custkey, o_totalprice FROM orders)
SELECT c.c_custkey, c.c_name, {money_sum_sql('s.o_totalprice')} AS revenue, CAST(COUNT(*) AS BIGINT) AS orders
FROM s JOIN customer c ON s.o_custkey = c.c_custkey GROUP BY ALL
""")
def hot_customer_join(spark, d):
    """JON-1 with a hot key: half of all sales belong to customer 0 (a till that
    books to one account)."""
    w = _w(spark, d)
    sales = w.orders.select(F.when(F.col("o_orderkey") % 2 == 0, F.lit(0).cast("long")).otherwise(F.col("o_custkey"))
                            .alias("o_custkey"), cents("o_totalprice").alias("c"))
    j = hot_key_join(sales, w.customer.select("c_custkey", "c_name"), "o_custkey", "c_custkey")
    return j.groupBy("c_custkey", "c_name").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("orders")).select(
        "c_custkey", "c_name", out_cents("c").alias("revenue"), "orders")
