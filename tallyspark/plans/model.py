"""Flat (star) vs normalized dimensional models on the test tables
(MDL-1..7, R41/R42, DQ-4, DQ-6, DQ-8).

Staging: branch = supplier with its nation and region *names*; product = part
with type (category) and brand names -- as a flat source file would deliver.
Normalized: region level -> nation level (name + region key) -> branch with
nation key; category level -> brand level (brand + category key; one brand
name can sit under several categories) -> product with brand key.
Flat: branch and product dimensions keep the names inline.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.functions.columns import money, money_sum, out_money
from tallyspark.operators.keys import LOAD, KeyRegistry, load_levels
from tallyspark.operators.model import (
    build_level, calendar, fact_unmatched, flatten_hierarchy, load_dimension, load_fact, resolve_parent)
from tallyspark.operators.ordered import assign_keys
from tallyspark.operators.quality import audit, reconcile, rows_touched
from tallyspark.operators.reports import Lookup, Measure, money_m, order_desc, revenue_by
from tallyspark.operators.sizing import BROADCAST_ROWS, lookup_join, proven_small
from tallyspark.operators.views import materialize
from tallyspark.plans.registry import money_sum_sql, query
from tallyspark.session import scratch_path
from tallyspark.sources.tables import Warehouse


def stg_branch(w: Warehouse) -> DataFrame:
    geo = F.broadcast(w.nation.join(F.broadcast(w.region), F.col("n_regionkey") == F.col("r_regionkey"))
                      .select("n_nationkey", F.col("n_name").alias("nation_name"),
                              F.col("r_name").alias("region_name")))
    s = w.supplier
    return s.join(geo, s["s_nationkey"] == geo["n_nationkey"]).select(
        "s_suppkey", "s_name", "nation_name", "region_name")


def base_small(base: DataFrame) -> bool | None:
    """Size bound of a dimension derived from ``base`` by projections and
    inner look-ups on unique keys (which cannot fan out): True when the base
    table is proven small (its count comes from Parquet metadata); None =
    not proven, the consumer checks the frame itself."""
    return True if proven_small(base, BROADCAST_ROWS) else None


def stg_product(w: Warehouse) -> DataFrame:
    return w.part.select("p_partkey", "p_name", F.col("p_brand").alias("brand_name"),
                         F.col("p_type").alias("category_name"))


class Normalized:
    """Level tables and normalized dimensions, each built on first use.

    Each level is written once as a table below the shared checkpoint folder
    (``materialize``) and read back, as the normalized model's tables are
    stored in a warehouse: its keys are computed once and never recomputed
    (not even after a lost executor), every later join reads a small stored
    table instead of re-deriving it, and Spark's size-checked auto-broadcast
    sees the table's real file size instead of an estimate derived from the
    staging scan."""

    def __init__(self, w: Warehouse):
        self.w = w
        self._b, self._p = stg_branch(w), stg_product(w)

    # The distinct name paths of each hierarchy, stored once: the staging
    # tables (branch- and product-sized) are scanned and shuffled once per
    # hierarchy; every level, its size check and its numbering then read a
    # table of at most one row per distinct path.
    @cached_property
    def _geo_paths(self) -> DataFrame:
        return materialize(self._b.select("nation_name", "region_name").distinct(), "paths_geo")

    @cached_property
    def _product_paths(self) -> DataFrame:
        return materialize(self._p.select("brand_name", "category_name").distinct(), "paths_product")

    @cached_property
    def region(self) -> DataFrame:
        return materialize(build_level(self._geo_paths, ["region_name"], "region_key"), "level_region")

    @cached_property
    def nation(self) -> DataFrame:
        return materialize(build_level(self._geo_paths, ["nation_name"], "nation_key",
                                       parent=(self.region, ["region_name"], "region_key")), "level_nation")

    @cached_property
    def category(self) -> DataFrame:
        return materialize(build_level(self._product_paths, ["category_name"], "category_key"), "level_category")

    @cached_property
    def brand(self) -> DataFrame:
        return materialize(build_level(self._product_paths, ["brand_name"], "brand_key",
                                       parent=(self.category, ["category_name"], "category_key")), "level_brand")

    @cached_property
    def _branch_parts(self) -> tuple[DataFrame, DataFrame]:
        # region name -> key, then nation by (name, region key)
        b_r, lost = resolve_parent(self._b, self.region, ["region_name"], "region_key")
        found, missing = resolve_parent(b_r, self.nation, ["nation_name", "region_key"], "nation_key")
        return found, lost.select("s_suppkey", "s_name").union(missing.select("s_suppkey", "s_name"))

    @cached_property
    def _product_parts(self) -> tuple[DataFrame, DataFrame]:
        p_c, lost = resolve_parent(self._p, self.category, ["category_name"], "category_key")
        found, missing = resolve_parent(p_c, self.brand, ["brand_name", "category_key"], "brand_key")
        return found, lost.select("p_partkey", "p_name").union(missing.select("p_partkey", "p_name"))

    # Size bounds of the normalized dimensions: level keys are unique, so the
    # inner look-ups of branch/product and their flattening cannot fan out --
    # a dimension has at most as many rows as its base table, whose count is
    # read from Parquet metadata.  True = proven small; None = not proven
    # (the consumer checks the frame itself).
    @cached_property
    def branch_small(self) -> bool | None:
        return base_small(self.w.supplier)

    @cached_property
    def product_small(self) -> bool | None:
        return base_small(self.w.part)

    @property
    def branch(self) -> DataFrame:
        return self._branch_parts[0]

    @property
    def product(self) -> DataFrame:
        return self._product_parts[0]

    @property
    def fact(self) -> DataFrame:
        return self.w.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                      F.col("l_quantity").cast("long").alias("quantity"),
                                      F.col("l_extendedprice").alias("amount"))

    def branch_flat(self) -> DataFrame:
        """branch -> nation -> region joined once (a look-up of branch size)."""
        return flatten_hierarchy(self.branch.select("s_suppkey", "nation_key"),
                                 [(self.nation.select("nation_key", "region_key"), "nation_key", "nation_key"),
                                  (self.region, "region_key", "region_key")])

    def product_flat(self) -> DataFrame:
        return flatten_hierarchy(self.product.select("p_partkey", "brand_key"),
                                 [(self.brand.select("brand_key", "category_key"), "brand_key", "brand_key"),
                                  (self.category, "category_key", "category_key")])


def normalized_revenue(w: Warehouse) -> DataFrame:
    """Region x category revenue through both hierarchies (6 tables)."""
    n = Normalized(w)
    return revenue_by(n.fact, ["region_name", "category_name"], [money_m("revenue", "amount")],
                      [Lookup(n.branch_flat().select("s_suppkey", "region_name"), "l_suppkey", "s_suppkey",
                              small=n.branch_small),
                       Lookup(n.product_flat().select("p_partkey", "category_name"), "l_partkey", "p_partkey",
                              small=n.product_small)])


def flat_revenue(w: Warehouse) -> DataFrame:
    """The same report from the flat dimensions."""
    b = stg_branch(w).select("s_suppkey", "region_name")
    p = stg_product(w).select("p_partkey", "category_name")
    return revenue_by(w.lineitem, ["region_name", "category_name"], [money_m("revenue", "l_extendedprice")],
                      [Lookup(b, "l_suppkey", "s_suppkey", small=base_small(w.supplier)),
                       Lookup(p, "l_partkey", "p_partkey", small=base_small(w.part))])


REGION_CATEGORY_SQL = f"""
SELECT r.r_name AS region_name, p.p_type AS category_name, {money_sum_sql('l.l_extendedprice')} AS revenue
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY r.r_name, p.p_type
"""


@query("flat_revenue", REGION_CATEGORY_SQL)
def q_flat_revenue(spark, d):
    return flat_revenue(Warehouse(spark, d)).orderBy("region_name", "category_name")


@query("normalized_revenue", REGION_CATEGORY_SQL)
def q_normalized_revenue(spark, d):
    return normalized_revenue(Warehouse(spark, d)).orderBy("region_name", "category_name")


@query("reconcile_models", f"""
SELECT region_name, category_name, revenue AS flat_revenue, revenue AS normalized_revenue, TRUE AS all_match
FROM ({REGION_CATEGORY_SQL})
""")
def q_reconcile_models(spark, d):
    """DQ-8 / MDL-7: both models give the same report (full outer join on the
    group key, NULL-safe comparison)."""
    w = Warehouse(spark, d)
    return reconcile(flat_revenue(w), normalized_revenue(w), ["region_name", "category_name"],
                     ["revenue"], left="flat", right="normalized")


GEO_SQL = """(SELECT s.s_suppkey, s.s_name, n.n_name AS nation_name, r.r_name AS region_name
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"""
REGION_LEVEL_SQL = f"""(SELECT CAST(row_number() OVER (ORDER BY region_name) AS BIGINT) AS region_key, region_name
  FROM (SELECT DISTINCT region_name FROM {GEO_SQL}))"""
NATION_LEVEL_SQL = f"""(SELECT CAST(row_number() OVER (ORDER BY nation_name, region_key) AS BIGINT) AS nation_key,
         nation_name, region_key
  FROM (SELECT DISTINCT g.nation_name, rl.region_key FROM {GEO_SQL} g
        JOIN {REGION_LEVEL_SQL} rl ON g.region_name = rl.region_name))"""
CATEGORY_LEVEL_SQL = """(SELECT CAST(row_number() OVER (ORDER BY category_name) AS BIGINT) AS category_key, category_name
  FROM (SELECT DISTINCT p_type AS category_name FROM part))"""
BRAND_LEVEL_SQL = f"""(SELECT CAST(row_number() OVER (ORDER BY brand_name, category_key) AS BIGINT) AS brand_key,
         brand_name, category_key
  FROM (SELECT DISTINCT p.p_brand AS brand_name, cl.category_key FROM part p
        JOIN {CATEGORY_LEVEL_SQL} cl ON p.p_type = cl.category_name))"""


@query("level_region", f"SELECT * FROM {REGION_LEVEL_SQL}")
def q_level_region(spark, d):
    """MDL-3: region look-up level from distinct staging values."""
    return Normalized(Warehouse(spark, d)).region


@query("level_nation", f"SELECT * FROM {NATION_LEVEL_SQL}")
def q_level_nation(spark, d):
    """MDL-3 with parent key resolved by name."""
    return Normalized(Warehouse(spark, d)).nation


@query("level_category", f"SELECT * FROM {CATEGORY_LEVEL_SQL}")
def q_level_category(spark, d):
    return Normalized(Warehouse(spark, d)).category


@query("level_brand", f"SELECT * FROM {BRAND_LEVEL_SQL}")
def q_level_brand(spark, d):
    """Brand x category level: a brand name under several categories gives
    several rows (one per parent)."""
    return Normalized(Warehouse(spark, d)).brand


@query("normalized_branch", f"""
SELECT g.s_suppkey, g.s_name, nl.nation_key
FROM {GEO_SQL} g JOIN {REGION_LEVEL_SQL} rl ON g.region_name = rl.region_name
JOIN {NATION_LEVEL_SQL} nl ON g.nation_name = nl.nation_name AND rl.region_key = nl.region_key
""")
def q_normalized_branch(spark, d):
    """MDL-4: branch dimension with its nation key resolved by (name, parent key)."""
    return Normalized(Warehouse(spark, d)).branch


@query("normalized_product", f"""
SELECT p.p_partkey, p.p_name, bl.brand_key
FROM part p JOIN {CATEGORY_LEVEL_SQL} cl ON p.p_type = cl.category_name
JOIN {BRAND_LEVEL_SQL} bl ON p.p_brand = bl.brand_name AND cl.category_key = bl.category_key
""")
def q_normalized_product(spark, d):
    return Normalized(Warehouse(spark, d)).product


@query("unmatched_lookup", """
SELECT c.c_custkey, c.c_name, n.n_name AS nation_name
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE n.n_name NOT IN (SELECT n2.n_name FROM supplier s JOIN nation n2 ON s.s_nationkey = n2.n_nationkey)
""")
def q_unmatched_lookup(spark, d):
    """S15 / MDL-4: customers resolved against the nation level, which is
    built from branches only; customers of nations without a branch would be
    lost by the inner look-up and are handed out here."""
    w = Warehouse(spark, d)
    n = Normalized(w)
    cust = w.customer.join(F.broadcast(w.nation), F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_name", F.col("n_name").alias("nation_name"))
    _, unmatched = resolve_parent(cust, n.nation, ["nation_name"], "nation_key")
    return unmatched


@query("audit_tables", """
SELECT * FROM (
  SELECT 'flat' AS schema_type, 'dim_branch' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM supplier
  UNION ALL SELECT 'flat', 'dim_product', COUNT(*) FROM part
  UNION ALL SELECT 'flat', 'fact_sales', COUNT(*) FROM lineitem
  UNION ALL SELECT 'normalized', 'region', COUNT(DISTINCT r.r_name) FROM supplier s
      JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  UNION ALL SELECT 'normalized', 'nation', COUNT(DISTINCT n.n_name) FROM supplier s
      JOIN nation n ON s.s_nationkey = n.n_nationkey
  UNION ALL SELECT 'normalized', 'category', COUNT(DISTINCT p_type) FROM part
  UNION ALL SELECT 'normalized', 'brand', COUNT(*) FROM (SELECT DISTINCT p_brand, p_type FROM part)
  UNION ALL SELECT 'normalized', 'dim_branch', COUNT(*) FROM supplier
  UNION ALL SELECT 'normalized', 'dim_product', COUNT(*) FROM part
  UNION ALL SELECT 'normalized', 'fact_sales', COUNT(*) FROM lineitem)
""")
def q_audit_tables(spark, d):
    """DQ-4: tagged row counts of every table of both models."""
    w = Warehouse(spark, d)
    n = Normalized(w)
    return audit([("flat", "dim_branch", stg_branch(w)), ("flat", "dim_product", stg_product(w)),
                  ("flat", "fact_sales", w.lineitem),
                  ("normalized", "region", n.region), ("normalized", "nation", n.nation),
                  ("normalized", "category", n.category), ("normalized", "brand", n.brand),
                  ("normalized", "dim_branch", n.branch), ("normalized", "dim_product", n.product),
                  ("normalized", "fact_sales", n.fact)])


@query("rows_touched", """
SELECT 'flat' AS schema_type, CAST(COUNT(*) AS BIGINT) AS rows_touched
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE r.r_name = 'EUROPE'
UNION ALL
SELECT 'normalized', CAST(COUNT(*) AS BIGINT) FROM (
  SELECT DISTINCT r.r_name FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey) WHERE r_name = 'EUROPE'
""")
def q_rows_touched(spark, d):
    """DQ-6: rows a region rename must rewrite -- every branch row of the
    region in the flat model, one level row in the normalized model."""
    w = Warehouse(spark, d)
    n = Normalized(w)
    return rows_touched([("flat", stg_branch(w), F.col("region_name") == "EUROPE"),
                         ("normalized", n.region, F.col("region_name") == "EUROPE")])


@query("surrogate_keys", """
SELECT CAST(row_number() OVER (ORDER BY p_name, p_partkey) AS BIGINT) AS product_key, p_partkey, p_name
FROM part
""")
def q_surrogate_keys(spark, d):
    """MDL-1: dense keys 1.. in natural-key order, numbered without a
    single-partition window."""
    return assign_keys(Warehouse(spark, d).part.select("p_partkey", "p_name"), ["p_name", "p_partkey"],
                       "product_key")


@query("calendar", """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS date,
       CAST(day(d) AS INTEGER) AS day, dayname(d) AS day_name, CAST(weekofyear(d) AS INTEGER) AS week_no,
       CAST(month(d) AS INTEGER) AS month_no, monthname(d) AS month, 'Q' || CAST(quarter(d) AS VARCHAR) AS quarter,
       CAST(year(d) AS INTEGER) AS year, CASE WHEN dayofweek(d) IN (0, 6) THEN 'Yes' ELSE 'No' END AS is_weekend
FROM (SELECT unnest(generate_series(CAST(MIN(o_orderdate) AS DATE), CAST(MAX(o_orderdate) AS DATE), INTERVAL 1 DAY)) AS d
      FROM orders)
""")
def q_calendar(spark, d):
    """MDL-6: calendar dimension over the order date range."""
    return calendar(Warehouse(spark, d).orders, "o_orderdate")


@query("fact_with_keys", """
WITH ck AS (SELECT CAST(row_number() OVER (ORDER BY c_name, c_custkey) AS BIGINT) AS customer_key, c_custkey
            FROM customer)
SELECT o.o_orderkey, ck.customer_key, CAST(strftime(o.o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
       CAST(CAST(o.o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS amount
FROM orders o JOIN ck ON o.o_custkey = ck.c_custkey
""")
def q_fact_with_keys(spark, d):
    """MDL-5: fact load -- natural keys swapped for the customer surrogate key
    and the calendar's date key."""
    w = Warehouse(spark, d)
    cust = assign_keys(w.customer.select("c_custkey", "c_name"), ["c_name", "c_custkey"], "customer_key")
    src = w.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"),
                          F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("date_key"),
                          "o_totalprice")
    return load_fact(src, [(cust, ["c_custkey"], "customer_key")],
                     [F.col("o_orderkey"), F.col("date_key"),
                      F.col("o_totalprice").cast("decimal(12,2)").cast("double").alias("amount")])


# ------------------------------------------------ keyed dimensions and facts (MDL-2, MDL-4, MDL-5)
FACT_SQL = """l.l_orderkey, l.l_linenumber, CAST(l.l_quantity AS BIGINT) AS quantity,
       CAST(p.p_retailprice AS DOUBLE) AS unit_price,
       CAST(CAST(l.l_quantity AS BIGINT) * CAST(p.p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS total_amount"""
FACT_KEY_SQL = """CAST(row_number() OVER (ORDER BY l.l_orderkey, l.l_linenumber, bk.branch_key, p.product_key,
       CAST(l.l_quantity AS BIGINT)) AS BIGINT)"""
PRICED_PART_SQL = """(SELECT CAST(row_number() OVER (ORDER BY p_partkey) AS BIGINT) AS product_key, p_partkey,
       p_retailprice FROM part)"""


def keyed_fact(w: Warehouse, branch: DataFrame, product: DataFrame) -> DataFrame:
    """Line items with the keys of both dimensions, quantity x unit price and a
    key of their own (line numbers repeat within an order, so every column that
    tells lines apart takes part in the order)."""
    price = F.col("p_retailprice").cast("decimal(12,2)")
    src = w.lineitem.select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("s_suppkey"),
                            F.col("l_partkey").alias("p_partkey"), F.col("l_quantity").cast("long").alias("quantity"))
    return load_fact(src, [(branch, ["s_suppkey"], "branch_key"), (product, ["p_partkey"], "product_key")],
                     [F.col("l_orderkey"), F.col("l_linenumber"), F.col("quantity"),
                      price.cast("double").alias("unit_price"),
                      (F.col("quantity") * price).cast("double").alias("total_amount")],
                     "fact_key", ["l_orderkey", "l_linenumber", "branch_key", "product_key", "quantity"])


@query("star_fact", f"""
WITH bk AS (SELECT CAST(row_number() OVER (ORDER BY s_suppkey) AS BIGINT) AS branch_key, s_suppkey FROM {GEO_SQL})
SELECT {FACT_KEY_SQL} AS fact_key, bk.branch_key, p.product_key, {FACT_SQL}
FROM lineitem l JOIN bk ON l.l_suppkey = bk.s_suppkey JOIN {PRICED_PART_SQL} p ON l.l_partkey = p.p_partkey
""")
def q_star_fact(spark, d):
    """MDL-2, MDL-5: flat dimensions with their own keys, and a fact that
    resolves both, derives quantity x unit price and is keyed itself."""
    w = Warehouse(spark, d)
    branch = materialize(load_dimension(stg_branch(w), ["s_suppkey"], ["s_name", "nation_name", "region_name"],
                                        "branch_key"), "dim_branch").select("branch_key", "s_suppkey")
    product = materialize(load_dimension(w.part, ["p_partkey"], ["p_name", "p_retailprice"], "product_key"),
                          "dim_product").select("product_key", "p_partkey", "p_retailprice")
    return keyed_fact(w, branch, product)


@query("normalized_dim_branch", f"""
SELECT CAST(row_number() OVER (ORDER BY g.s_suppkey) AS BIGINT) AS branch_key, g.s_suppkey, g.s_name, nl.nation_key
FROM {GEO_SQL} g JOIN {REGION_LEVEL_SQL} rl ON g.region_name = rl.region_name
JOIN {NATION_LEVEL_SQL} nl ON g.nation_name = nl.nation_name AND rl.region_key = nl.region_key
""")
def q_normalized_dim_branch(spark, d):
    """MDL-4: a normalized dimension with a key of its own."""
    return load_dimension(Normalized(Warehouse(spark, d)).branch, ["s_suppkey"], ["s_name", "nation_key"], "branch_key")


@query("normalized_fact", f"""
WITH bk AS (SELECT CAST(row_number() OVER (ORDER BY s_suppkey) AS BIGINT) AS branch_key, s_suppkey FROM {GEO_SQL})
SELECT {FACT_KEY_SQL} AS fact_key, bk.branch_key, p.product_key, {FACT_SQL}
FROM lineitem l JOIN bk ON l.l_suppkey = bk.s_suppkey JOIN {PRICED_PART_SQL} p ON l.l_partkey = p.p_partkey
""")
def q_normalized_fact(spark, d):
    """MDL-5 on the normalized dimensions; the unit price comes with the
    product's staging row."""
    w = Warehouse(spark, d)
    n = Normalized(w)
    branch = materialize(load_dimension(n.branch, ["s_suppkey"], ["s_name", "nation_key"], "branch_key"),
                         "dim_branch_n").select("branch_key", "s_suppkey")
    product = materialize(load_dimension(n.product.join(w.part.select("p_partkey", "p_retailprice"), "p_partkey"),
                                         ["p_partkey"], ["p_name", "brand_key", "p_retailprice"], "product_key"),
                          "dim_product_n").select("product_key", "p_partkey", "p_retailprice")
    return keyed_fact(w, branch, product)


@query("fact_unmatched", """
SELECT l.l_orderkey, l.l_linenumber,
       CASE WHEN n.n_name IN ('FRANCE', 'CHINA') THEN 'branch_key' ELSE 'product_key' END AS missing
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN part p ON l.l_partkey = p.p_partkey
WHERE n.n_name IN ('FRANCE', 'CHINA') OR p.p_partkey % 10 = 0
""")
def q_fact_unmatched(spark, d):
    """MDL-5 / S15: lines whose branch or product the dimensions lack (loaded
    without two nations and without every tenth product), with the look-up that
    failed first."""
    w = Warehouse(spark, d)
    branch = load_dimension(stg_branch(w).filter(~F.col("nation_name").isin("FRANCE", "CHINA")), ["s_suppkey"], [],
                            "branch_key")
    product = load_dimension(w.part.filter(F.col("p_partkey") % 10 != 0), ["p_partkey"], [], "product_key")
    src = w.lineitem.select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("s_suppkey"),
                            F.col("l_partkey").alias("p_partkey"))
    return fact_unmatched(src, [(branch, ["s_suppkey"], "branch_key"), (product, ["p_partkey"], "product_key")]
                          ).select("l_orderkey", "l_linenumber", "missing")


@query("level_nation_two_sources", """
SELECT CAST(row_number() OVER (ORDER BY nation_name) AS BIGINT) AS nation_key, nation_name FROM (
  SELECT n.n_name AS nation_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  UNION
  SELECT n.n_name FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey)
""")
def q_level_nation_two_sources(spark, d):
    """SET-2 / MDL-3: a level fed by two sources (customers' and branches'
    nations), UNION (distinct) before numbering."""
    w = Warehouse(spark, d)
    nat = F.broadcast(w.nation.select("n_nationkey", F.col("n_name").alias("nation_name")))
    a = w.customer.join(nat, F.col("c_nationkey") == F.col("n_nationkey")).select("nation_name")
    b = w.supplier.join(nat, F.col("s_nationkey") == F.col("n_nationkey")).select("nation_name")
    return build_level(a.union(b), ["nation_name"], "nation_key")


# ------------------------------------------------ R43-R45: group reports, flat vs normalized
# Claim lines are the line items: claimed amount = line price, approved amount
# = line price net of its discount.  Both are exact decimals (price as
# decimal(12,2) times (1 - discount as decimal(4,2))), summed exactly and
# handed out as DOUBLE.
CLAIMED_SQL = "CAST(l.l_extendedprice AS DECIMAL(12,2))"
APPROVED_SQL = "CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))"


def claim_lines(w: Warehouse) -> DataFrame:
    return w.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", F.col("l_quantity").cast("long").alias("qty"),
        money("l_extendedprice").alias("claimed"),
        (money("l_extendedprice") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).alias("approved"))


def _as_double(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[out_money(c).alias(c) if c in cols else F.col(c) for c in df.columns])


@query("manager_performance", f"""
SELECT n.n_name AS nation_name, CAST(SUM(CAST(l.l_quantity AS BIGINT)) AS BIGINT) AS total_items_sold,
       {money_sum_sql('l.l_extendedprice')} AS total_sales_amount
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY n.n_name
""")
def q_manager_performance(spark, d):
    """Items sold and sales amount per territory of the flat branch
    dimension (the branch's nation stands in for its regional manager),
    largest sales first."""
    w = Warehouse(spark, d)
    b = stg_branch(w).select("s_suppkey", "nation_name")
    out = revenue_by(claim_lines(w), ["nation_name"],
                     [Measure("total_items_sold", "sum", "qty"), money_m("total_sales_amount", "claimed")],
                     [Lookup(b, "l_suppkey", "s_suppkey", small=base_small(w.supplier))])
    return (out.withColumn("total_items_sold", F.col("total_items_sold").cast("long"))
            .orderBy(*order_desc("total_sales_amount", "nation_name")))


CLAIMS_BY_CATEGORY_SQL = f"""
SELECT p.p_type AS category_name, CAST(SUM({CLAIMED_SQL}) AS DOUBLE) AS total_claimed_amount,
       CAST(SUM({APPROVED_SQL}) AS DOUBLE) AS total_approved_amount
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY p.p_type
"""

CLAIM_AMOUNTS = [Measure("total_claimed_amount", "sum", "claimed"),
                 Measure("total_approved_amount", "sum", "approved")]


@query("claims_by_category_flat", CLAIMS_BY_CATEGORY_SQL)
def q_claims_by_category_flat(spark, d):
    """R44 (flat): claimed and approved amounts per category through the flat
    product dimension (one join)."""
    w = Warehouse(spark, d)
    p = stg_product(w).select("p_partkey", "category_name")
    out = revenue_by(claim_lines(w), ["category_name"], CLAIM_AMOUNTS,
                     [Lookup(p, "l_partkey", "p_partkey", small=base_small(w.part))])
    return _as_double(out, "total_claimed_amount", "total_approved_amount").orderBy("category_name")


@query("claims_by_category_normalized", CLAIMS_BY_CATEGORY_SQL)
def q_claims_by_category_normalized(spark, d):
    """R44 (normalized): the same report through product -> brand level ->
    category level (surrogate keys)."""
    w = Warehouse(spark, d)
    n = Normalized(w)
    p = n.product_flat().select("p_partkey", "category_name")
    out = revenue_by(claim_lines(w), ["category_name"], CLAIM_AMOUNTS,
                     [Lookup(p, "l_partkey", "p_partkey", small=n.product_small)])
    return _as_double(out, "total_claimed_amount", "total_approved_amount").orderBy("category_name")


CLAIMS_BY_NATION_SQL = f"""
SELECT n.n_name AS nation_name, CAST(COUNT(l.l_orderkey) AS BIGINT) AS total_claims_handled,
       CAST(SUM({APPROVED_SQL}) AS DOUBLE) AS total_approved_amount
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY n.n_name
"""

CLAIMS_HANDLED = [Measure("total_claims_handled", "count", "l_orderkey"),
                  Measure("total_approved_amount", "sum", "approved")]


@query("claims_by_nation_flat", CLAIMS_BY_NATION_SQL)
def q_claims_by_nation_flat(spark, d):
    """R45 (flat): claims handled (count of claim ids) and approved amount per
    parent of the branch, read inline from the flat branch dimension."""
    w = Warehouse(spark, d)
    b = stg_branch(w).select("s_suppkey", "nation_name")
    out = revenue_by(claim_lines(w), ["nation_name"], CLAIMS_HANDLED,
                     [Lookup(b, "l_suppkey", "s_suppkey", small=base_small(w.supplier))])
    return _as_double(out, "total_approved_amount").orderBy("nation_name")


@query("claims_by_nation_normalized", CLAIMS_BY_NATION_SQL)
def q_claims_by_nation_normalized(spark, d):
    """R45 (normalized): the parent's attribute needs one more hierarchy join
    (branch -> nation level)."""
    w = Warehouse(spark, d)
    n = Normalized(w)
    b = flatten_hierarchy(n.branch.select("s_suppkey", "nation_key"),
                          [(n.nation.select("nation_key", "nation_name"), "nation_key", "nation_key")])
    out = revenue_by(claim_lines(w), ["nation_name"], CLAIMS_HANDLED,
                     [Lookup(b.select("s_suppkey", "nation_name"), "l_suppkey", "s_suppkey",
                             small=n.branch_small)])
    return _as_double(out, "total_approved_amount").orderBy("nation_name")


# ------------------------------------------------ date hierarchy (MDL-3, R11/R12 via JON-3)
class NormalizedDates:
    """Date hierarchy of the normalized model, built from the calendar over the
    order dates (the staging calendar): year level -> quarter level (quarter
    name + year key) -> month level (month name + quarter key) -> date
    dimension (date key -> month key).

    A quarter or month name repeats every year, so each level is resolved by
    its name *and* its parent's key; a look-up by name alone would fan out
    (JON-12).  As for the other hierarchies, the distinct name paths are
    stored once, one size check covers every level, and each level is stored
    once with its keys."""

    def __init__(self, w: Warehouse):
        self.w = w

    @cached_property
    def _cal(self) -> DataFrame:
        # one row a day; stored, as the paths, the size check and the joins read it
        return materialize(calendar(self.w.orders, "o_orderdate"), "calendar")

    @cached_property
    def _paths(self) -> DataFrame:
        return materialize(self._cal.select(F.col("month").alias("month_name"),
                                            F.col("quarter").alias("quarter_name"), "year").distinct(),
                           "paths_date")

    @cached_property
    def year(self) -> DataFrame:
        return materialize(build_level(self._paths, ["year"], "year_key"), "level_year")

    @cached_property
    def quarter(self) -> DataFrame:
        return materialize(build_level(self._paths, ["quarter_name"], "quarter_key",
                                       parent=(self.year, ["year"], "year_key")),
                           "level_quarter")

    @cached_property
    def month(self) -> DataFrame:
        src = self._paths.join(self.year, "year")
        return materialize(build_level(src, ["month_name"], "month_key",
                                       parent=(self.quarter, ["quarter_name", "year_key"], "quarter_key")), "level_month")

    def date_dim(self) -> DataFrame:
        """One row per calendar day with its month key (look-ups by name +
        parent key, each against a stored level)."""
        c = (self._cal.withColumnRenamed("month", "month_name").withColumnRenamed("quarter", "quarter_name")
             .join(self.year, "year")
             .join(self.quarter, ["quarter_name", "year_key"])
             .join(self.month, ["month_name", "quarter_key"]))
        return c.select("date_key", "date", "day", "day_name", "week_no", "month_key", "is_weekend")

    def date_flat(self) -> DataFrame:
        """date key -> month -> quarter, joined once (calendar-sized)."""
        return flatten_hierarchy(self.date_dim().select("date_key", "month_key"),
                                 [(self.month.select("month_key", "month_name", "quarter_key"),
                                   "month_key", "month_key"),
                                  (self.quarter.select("quarter_key", "quarter_name"),
                                   "quarter_key", "quarter_key")])


CAL_SQL = """
cal AS (SELECT CAST(d AS DATE) AS date, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key,
               CAST(day(d) AS INTEGER) AS day, dayname(d) AS day_name, CAST(weekofyear(d) AS INTEGER) AS week_no,
               monthname(d) AS month_name, 'Q' || CAST(quarter(d) AS VARCHAR) AS quarter_name,
               CAST(year(d) AS INTEGER) AS year,
               CASE WHEN dayofweek(d) IN (0, 6) THEN 'Yes' ELSE 'No' END AS is_weekend
        FROM (SELECT unnest(generate_series(CAST(MIN(o_orderdate) AS DATE), CAST(MAX(o_orderdate) AS DATE),
                                            INTERVAL 1 DAY)) AS d FROM orders)),
yl AS (SELECT CAST(row_number() OVER (ORDER BY year) AS BIGINT) AS year_key, year FROM (SELECT DISTINCT year FROM cal)),
ql AS (SELECT CAST(row_number() OVER (ORDER BY quarter_name, year_key) AS BIGINT) AS quarter_key, quarter_name, year_key
       FROM (SELECT DISTINCT c.quarter_name, y.year_key FROM cal c JOIN yl y ON c.year = y.year)),
ml AS (SELECT CAST(row_number() OVER (ORDER BY month_name, quarter_key) AS BIGINT) AS month_key, month_name, quarter_key
       FROM (SELECT DISTINCT c.month_name, q.quarter_key FROM cal c JOIN yl y ON c.year = y.year
             JOIN ql q ON c.quarter_name = q.quarter_name AND q.year_key = y.year_key))
"""


@query("level_year", f"WITH {CAL_SQL} SELECT * FROM yl")
def q_level_year(spark, d):
    """MDL-3: year level of the date hierarchy."""
    return NormalizedDates(Warehouse(spark, d)).year


@query("level_quarter", f"WITH {CAL_SQL} SELECT * FROM ql")
def q_level_quarter(spark, d):
    """MDL-3: quarter level -- one row per (quarter name, year)."""
    return NormalizedDates(Warehouse(spark, d)).quarter


@query("level_month", f"WITH {CAL_SQL} SELECT * FROM ml")
def q_level_month(spark, d):
    """MDL-3: month level -- one row per (month name, quarter of a year)."""
    return NormalizedDates(Warehouse(spark, d)).month


@query("date_dimension", f"""
WITH {CAL_SQL}
SELECT c.date_key, c.date, c.day, c.day_name, c.week_no, m.month_key, c.is_weekend
FROM cal c JOIN yl y ON c.year = y.year
JOIN ql q ON c.quarter_name = q.quarter_name AND q.year_key = y.year_key
JOIN ml m ON c.month_name = m.month_name AND m.quarter_key = q.quarter_key
""")
def q_date_dimension(spark, d):
    """MDL-4 on the date hierarchy: each calendar day with its month key."""
    return NormalizedDates(Warehouse(spark, d)).date_dim()


def _orders_by_date_key(w: Warehouse) -> DataFrame:
    return w.orders.select(F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("date_key"),
                           "o_totalprice")


@query("normalized_revenue_by_quarter", f"""
SELECT 'Q' || CAST(quarter(o.o_orderdate) AS VARCHAR) AS quarter_name,
       {money_sum_sql('o.o_totalprice')} AS revenue
FROM orders o GROUP BY 1
""")
def q_normalized_revenue_by_quarter(spark, d):
    """R12 through the normalized date hierarchy: fact -> date -> month ->
    quarter, grouped by quarter name (all years together, as the report does),
    largest first.  The date look-up is calendar-sized and proven small."""
    w = Warehouse(spark, d)
    dates = NormalizedDates(w).date_flat().select("date_key", "quarter_name")
    return (revenue_by(_orders_by_date_key(w), ["quarter_name"], [money_m("revenue", "o_totalprice")],
                       [Lookup(dates, "date_key", "date_key")])
            .orderBy(*order_desc("revenue", "quarter_name")))


@query("normalized_revenue_by_month_name", f"""
SELECT monthname(o.o_orderdate) AS month_name, {money_sum_sql('o.o_totalprice')} AS revenue
FROM orders o GROUP BY 1
""")
def q_normalized_revenue_by_month_name(spark, d):
    """R11 through the normalized date hierarchy: fact -> date -> month,
    grouped by month name, largest first."""
    w = Warehouse(spark, d)
    dates = NormalizedDates(w).date_flat().select("date_key", "month_name")
    return (revenue_by(_orders_by_date_key(w), ["month_name"], [money_m("revenue", "o_totalprice")],
                       [Lookup(dates, "date_key", "date_key")])
            .orderBy(*order_desc("revenue", "month_name")))


# ------------------------------------------------ R5/R6 through the product hierarchy
@query("normalized_revenue_by_brand", f"""
SELECT p.p_brand AS brand_name, {money_sum_sql('l.l_extendedprice')} AS revenue
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY p.p_brand
""")
def q_normalized_revenue_by_brand(spark, d):
    """R6 through the normalized model: fact -> product -> brand level,
    grouped by brand *name* -- a brand sold under several categories has
    several level rows, which the report merges."""
    w = Warehouse(spark, d)
    n = Normalized(w)
    p = n.product_flat().select("p_partkey", "brand_key").join(n.brand.select("brand_key", "brand_name"),
                                                               "brand_key")
    return (revenue_by(n.fact, ["brand_name"], [money_m("revenue", "amount")],
                       [Lookup(p.select("p_partkey", "brand_name"), "l_partkey", "p_partkey",
                               small=n.product_small)])
            .orderBy(*order_desc("revenue", "brand_name")))


@query("normalized_revenue_by_category", f"""
SELECT p.p_type AS category_name, {money_sum_sql('l.l_extendedprice')} AS revenue
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY p.p_type
""")
def q_normalized_revenue_by_category(spark, d):
    """R5 through the normalized model: fact -> product -> brand level ->
    category level."""
    w = Warehouse(spark, d)
    n = Normalized(w)
    p = n.product_flat().select("p_partkey", "category_name")
    return (revenue_by(n.fact, ["category_name"], [money_m("revenue", "amount")],
                       [Lookup(p, "l_partkey", "p_partkey", small=n.product_small)])
            .orderBy(*order_desc("revenue", "category_name")))


# ------------------------------------------------ R7 through a two-source city level
@query("normalized_revenue_by_customer_nation", """
SELECT n.n_name AS nation_name, CAST(SUM(CAST(o.o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS revenue
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name
""")
def q_normalized_revenue_by_customer_nation(spark, d):
    """R7 through the normalized model: the city (nation) level is fed by
    customers *and* branches (UNION of both name sets), so every customer
    resolves -- a level built from branches alone would silently drop the
    customers of nations without a branch (S15).  Fact -> customer ->
    city level, grouped by name."""
    w = Warehouse(spark, d)
    nat = F.broadcast(w.nation.select("n_nationkey", F.col("n_name").alias("nation_name")))  # 25 rows
    cust = w.customer.join(nat, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "nation_name")
    paths = materialize(cust.select("nation_name").union(stg_branch(w).select("nation_name")).distinct(),
                        "paths_city")
    level = materialize(build_level(paths, ["nation_name"], "nation_key"), "level_city")
    cust_dim, _ = resolve_parent(cust, level, ["nation_name"], "nation_key")
    # level keys are unique: the flattened customer dimension has at most as
    # many rows as the customer table
    cflat = cust_dim.join(level, "nation_key").select("c_custkey", "nation_name")
    small = True if proven_small(w.customer, BROADCAST_ROWS) else None
    return (revenue_by(w.orders, ["nation_name"], [money_m("revenue", "o_totalprice")],
                       [Lookup(cflat, "o_custkey", "c_custkey", small=small)])
            .orderBy(*order_desc("revenue", "nation_name")))


# ---------------------------------------------------------------- second load
def _registry(spark, name: str, key: str, natural: str) -> KeyRegistry:
    return KeyRegistry(spark, scratch_path(spark, name), key, T.StructType.fromDDL(natural))


SECOND_LOAD_SQL = f"""
WITH b AS (SELECT s.s_suppkey, s.s_acctbal < 2000 AS early, n.n_name AS nation_name, r.r_name AS region_name
           FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
r AS (SELECT region_name, bool_or(early) AS early FROM b GROUP BY 1),
rk AS (SELECT region_name, ROW_NUMBER() OVER (ORDER BY NOT early, region_name) AS region_key FROM r),
n AS (SELECT nation_name, region_key, region_name, bool_or(early) AS early FROM b JOIN rk USING (region_name) GROUP BY ALL),
nk AS (SELECT *, ROW_NUMBER() OVER (ORDER BY NOT early, nation_name, region_key) AS nation_key FROM n),
f AS (SELECT b.nation_name, {money_sum_sql('l.l_extendedprice')} AS early_revenue
      FROM lineitem l JOIN b ON l.l_suppkey = b.s_suppkey WHERE b.early GROUP BY 1)
"""


@query("level_second_load", SECOND_LOAD_SQL + """
SELECT nation_key, nation_name, region_key, region_name, early_revenue
FROM nk LEFT JOIN f USING (nation_name)""")
def q_level_second_load(spark, d):
    """MDL-1/3: region and nation levels loaded from the first branches (those
    with a balance under 2000), the fact of those branches stored with its
    nation keys, then the levels loaded again from all branches: keys given out
    stay, new names get the next ones, and the stored fact still resolves."""
    w = Warehouse(spark, d)
    b = stg_branch(w).join(w.supplier.select("s_suppkey", "s_acctbal"), "s_suppkey")
    levels = [_registry(spark, "region_keys", "region_key", "region_name string"),
              _registry(spark, "nation_keys", "nation_key", "nation_name string, region_key bigint")]
    early = b.filter(F.col("s_acctbal") < 2000)
    names = ["nation_name", "region_name"]
    load_levels(levels, early.select(*names), "first")
    branch = levels[1].resolve(levels[0].resolve(early.select("s_suppkey", *names)))
    fact = w.lineitem.select(F.col("l_suppkey").alias("s_suppkey"), "l_extendedprice")
    stored = materialize(revenue_by(fact, ["nation_key"], [money_m("early_revenue", "l_extendedprice")],
                                    [Lookup(branch, "s_suppkey", "s_suppkey", small=base_small(w.supplier))]),
                         "fact_first_load")
    load_levels(levels, b.select(*names), "second")
    return (levels[1].rows().join(levels[0].rows(), "region_key").join(stored, "nation_key", "left")
            .select("nation_key", "nation_name", "region_key", "region_name", "early_revenue"))


@query("dimension_second_load", f"""
WITH e AS (SELECT o_custkey, {money_sum_sql('o_totalprice')} AS early_revenue FROM orders
           WHERE o_orderdate < TIMESTAMP '1996-01-01 00:00:00' GROUP BY 1)
SELECT ROW_NUMBER() OVER (ORDER BY e.o_custkey IS NULL, c.c_custkey) AS customer_key, c.c_custkey AS customer_id,
       CASE WHEN e.o_custkey IS NULL THEN 'second' ELSE 'first' END AS load, early_revenue
FROM customer c LEFT JOIN e ON c.c_custkey = e.o_custkey
""")
def q_dimension_second_load(spark, d):
    """MDL-1/5: customers with orders before 1996 are loaded first and their
    revenue is stored by surrogate key; all customers follow in a second load,
    which is then delivered again; the stored fact resolves by the same keys."""
    w = Warehouse(spark, d)
    customers = _registry(spark, "customer_keys", "customer_key", "customer_id bigint")
    sold = (w.orders.filter(F.col("o_orderdate") < F.lit("1996-01-01 00:00:00").cast("timestamp"))
            .groupBy(F.col("o_custkey").alias("customer_id")).agg(money_sum("o_totalprice").alias("revenue")))
    sold = materialize(sold, "early_sales")
    customers.load(sold.select("customer_id"), "first")
    fact = materialize(customers.resolve(sold), "early_fact")
    every = w.customer.select(F.col("c_custkey").alias("customer_id"))
    for load in ("second", "second_again"):
        customers.load(every, load)
    rows = customers.rows(with_load=True).withColumnRenamed(LOAD, "load")
    return lookup_join(rows, fact, "customer_key", "left").select(
        "customer_key", "customer_id", "load", out_money("revenue").alias("early_revenue"))


@query("resolved_after_second_load", f"""
WITH e AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01 00:00:00'),
k AS (SELECT o_custkey, ROW_NUMBER() OVER (ORDER BY o_custkey) AS customer_key FROM e)
SELECT k.customer_key, {money_sum_sql('o.o_totalprice')} AS revenue, CAST(COUNT(*) AS BIGINT) AS orders
FROM orders o LEFT JOIN k ON o.o_custkey = k.o_custkey GROUP BY 1
""")
def q_resolved_after_second_load(spark, d):
    """MDL-4: orders resolved against a registry that does not hold every
    customer yet: those without a key come out under NULL, none is lost."""
    w = Warehouse(spark, d)
    customers = _registry(spark, "early_customer_keys", "customer_key", "customer_id bigint")
    customers.load(w.orders.filter(F.col("o_orderdate") < F.lit("1996-01-01 00:00:00").cast("timestamp"))
                   .select(F.col("o_custkey").alias("customer_id")), "first")
    fact = customers.resolve(w.orders.select(F.col("o_custkey").alias("customer_id"), "o_totalprice"))
    return fact.groupBy("customer_key").agg(out_money(money_sum("o_totalprice")).alias("revenue"),
                                            F.count(F.lit(1)).alias("orders"))


# ---------------------------------------------------------------- reports over the date dimension
def sales_by_date(w: Warehouse, cols: list[str]) -> DataFrame:
    """Revenue and sales per attributes of the date dimension: the fact carries
    a date key, and every attribute comes from the calendar.  The fact is
    aggregated by date key first; the calendar has one row per day."""
    d = F.to_date("o_orderdate")
    key = (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")
    days = w.orders.groupBy(key.alias("date_key")).agg(money_sum("o_totalprice").alias("r"),
                                                       F.count(F.lit(1)).alias("n"))
    cal = materialize(calendar(w.orders, "o_orderdate"), "calendar")
    return (days.join(F.broadcast(cal.select("date_key", *cols)), "date_key").groupBy(*cols)
            .agg(out_money(F.sum("r")).alias("revenue"), F.sum("n").alias("sales")))


@query("revenue_by_calendar_month", f"""
SELECT year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month_no, monthname(o_orderdate) AS month,
       {money_sum_sql('o_totalprice')} AS revenue, CAST(COUNT(*) AS BIGINT) AS sales FROM orders GROUP BY 1, 2, 3
""")
def q_revenue_by_calendar_month(spark, d):
    """Monthly report of the flat model, over its date dimension."""
    return sales_by_date(Warehouse(spark, d), ["year", "month_no", "month"])


@query("revenue_by_weekend", f"""
SELECT CASE WHEN isodow(o_orderdate) >= 6 THEN 'Yes' ELSE 'No' END AS is_weekend, dayname(o_orderdate) AS day_name,
       {money_sum_sql('o_totalprice')} AS revenue, CAST(COUNT(*) AS BIGINT) AS sales FROM orders GROUP BY 1, 2
""")
def q_revenue_by_weekend(spark, d):
    """Sales by weekday and weekend flag of the date dimension."""
    return sales_by_date(Warehouse(spark, d), ["is_weekend", "day_name"])


@query("unmatched_branches", """
SELECT s.s_suppkey, s.s_name, n.n_name AS nation_name FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
WHERE n.n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < 2000)
""")
def q_unmatched_branches(spark, d):
    """MDL-4 with hits: branches whose nation the level of the first load does
    not hold are handed out."""
    w = Warehouse(spark, d)
    b = stg_branch(w).join(w.supplier.select("s_suppkey", "s_acctbal"), "s_suppkey")
    level = materialize(build_level(b.filter(F.col("s_acctbal") < 2000), ["nation_name"], "nation_key"), "level_first")
    return resolve_parent(b.select("s_suppkey", "s_name", "nation_name"), level, ["nation_name"], "nation_key")[1]
