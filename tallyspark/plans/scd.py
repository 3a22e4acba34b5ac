"""Slowly-changing-dimension scenarios on the customer table (SCD-1..13, DQ-5).

Dimension source: every customer with city = nation name, state = region
name, membership = market segment, segment = 'Premium' for an account balance
of at least 5000 else 'Regular'.

Update batch (derived from the customer table by a fixed business rule):
customers with a balance of at least 7000 are re-profiled -- membership
becomes HOUSEHOLD, segment Premium, and those with at least 8500 move to the
next nation (key + 1, wrapping at 25).  Effective dates are spread over
2026-04-01 .. 2026-04-10 by customer key.  Some updates change nothing
(already HOUSEHOLD, not moving): they must leave the dimension unchanged.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.columns import money_sum, out_money
from tallyspark.operators.ordered import assign_keys, with_neighbors
from tallyspark.operators.quality import history_metrics
from tallyspark.operators.scd import (
    as_of, as_of_join, attribute_changes, changed_rows, current_rows, history, hybrid_init, late_updates, scd1_apply, scd2_apply,
    scd2_init, scd3_apply, scd3_init, scd6_apply, scd6_init, scd_hybrid_apply)
from tallyspark.plans.registry import money_sum_sql, query
from tallyspark.sources.tables import Warehouse

START = dt.date(2026, 1, 1)
TRACKED = ["city", "state", "membership", "segment"]
ATTRS = ["customer_id", "customer_name", "city", "state", "membership", "segment"]


def _geo(w: Warehouse) -> DataFrame:
    # nation x region: 25 rows by definition of the nation table -> broadcast
    return F.broadcast(w.nation.join(F.broadcast(w.region), F.col("n_regionkey") == F.col("r_regionkey"))
                       .select("n_nationkey", "n_name", "r_name"))


def initial(w: Warehouse) -> DataFrame:
    c = w.customer
    return c.join(_geo(w), c["c_nationkey"] == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
        F.col("n_name").alias("city"), F.col("r_name").alias("state"),
        F.col("c_mktsegment").alias("membership"),
        F.when(F.col("c_acctbal") >= 5000, "Premium").otherwise("Regular").alias("segment"))


def updates(w: Warehouse) -> DataFrame:
    c = w.customer.filter(F.col("c_acctbal") >= 7000)
    target = F.when(F.col("c_acctbal") >= 8500, (F.col("c_nationkey") + 1) % 25).otherwise(F.col("c_nationkey"))
    c = c.withColumn("_nk", target)
    return c.join(_geo(w), c["_nk"] == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
        F.col("n_name").alias("city"), F.col("r_name").alias("state"),
        F.lit("HOUSEHOLD").alias("membership"), F.lit("Premium").alias("segment"),
        F.date_add(F.lit(dt.date(2026, 4, 1)), (F.col("c_custkey") % 10).cast("int")).alias("effective_date"))


INPUT_SQL = """
geo AS (SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
init AS (SELECT c.c_custkey AS customer_id, c.c_name AS customer_name, g.n_name AS city, g.r_name AS state,
                c.c_mktsegment AS membership,
                CASE WHEN c.c_acctbal >= 5000 THEN 'Premium' ELSE 'Regular' END AS segment
         FROM customer c JOIN geo g ON c.c_nationkey = g.n_nationkey),
upd AS (SELECT c.c_custkey AS customer_id, c.c_name AS customer_name, g.n_name AS city, g.r_name AS state,
               'HOUSEHOLD' AS membership, 'Premium' AS segment,
               CAST(DATE '2026-04-01' + CAST(c.c_custkey % 10 AS INTEGER) AS DATE) AS effective_date
        FROM customer c JOIN geo g
          ON g.n_nationkey = CASE WHEN c.c_acctbal >= 8500 THEN (c.c_nationkey + 1) % 25 ELSE c.c_nationkey END
        WHERE c.c_acctbal >= 7000),
chg AS (SELECT u.* FROM upd u JOIN init i ON u.customer_id = i.customer_id
        WHERE u.city IS DISTINCT FROM i.city OR u.state IS DISTINCT FROM i.state
           OR u.membership IS DISTINCT FROM i.membership OR u.segment IS DISTINCT FROM i.segment)
"""


@query("changed_customers", f"""
WITH {INPUT_SQL}
SELECT i.customer_id, i.city AS old_city, u.city AS new_city, i.state AS old_state, u.state AS new_state,
       i.membership AS old_membership, u.membership AS new_membership,
       i.segment AS old_segment, u.segment AS new_segment
FROM init i JOIN chg u ON i.customer_id = u.customer_id
""")
def q_changed_customers(spark, d):
    """SCD-1: keys whose tracked attributes changed, old and new side by side."""
    w = Warehouse(spark, d)
    return changed_rows(initial(w), updates(w).drop("effective_date"), "customer_id", TRACKED)


@query("attribute_changes", f"""
WITH {INPUT_SQL}
SELECT * FROM (
  SELECT i.customer_id, 'city' AS attribute, i.city AS old_value, u.city AS new_value FROM init i JOIN upd u USING (customer_id)
  UNION ALL SELECT i.customer_id, 'state', i.state, u.state FROM init i JOIN upd u USING (customer_id)
  UNION ALL SELECT i.customer_id, 'membership', i.membership, u.membership FROM init i JOIN upd u USING (customer_id)
  UNION ALL SELECT i.customer_id, 'segment', i.segment, u.segment FROM init i JOIN upd u USING (customer_id))
WHERE old_value IS DISTINCT FROM new_value
""")
def q_attribute_changes(spark, d):
    """SCD-2: attribute-level diff in long form (one join + unpivot)."""
    w = Warehouse(spark, d)
    return attribute_changes(initial(w), updates(w), "customer_id", TRACKED)


@query("scd1", f"""
WITH {INPUT_SQL}
SELECT i.customer_id, i.customer_name,
       COALESCE(u.city, i.city) AS city, COALESCE(u.state, i.state) AS state,
       COALESCE(u.membership, i.membership) AS membership, COALESCE(u.segment, i.segment) AS segment
FROM init i LEFT JOIN upd u ON i.customer_id = u.customer_id
""")
def q_scd1(spark, d):
    """SCD-3: type 1 overwrite."""
    w = Warehouse(spark, d)
    return scd1_apply(initial(w), updates(w), "customer_id", TRACKED)


SCD2_SQL = f"""
WITH {INPUT_SQL},
dim AS (SELECT *, DATE '2026-01-01' AS effective_date, DATE '9999-12-31' AS expiry_date, TRUE AS is_current FROM init),
scd2 AS (
  SELECT d.customer_id, d.customer_name, d.city, d.state, d.membership, d.segment, d.effective_date,
         CASE WHEN c.customer_id IS NULL THEN d.expiry_date ELSE CAST(c.effective_date - 1 AS DATE) END AS expiry_date,
         c.customer_id IS NULL AS is_current
  FROM dim d LEFT JOIN chg c ON d.customer_id = c.customer_id
  UNION ALL
  SELECT customer_id, customer_name, city, state, membership, segment, effective_date,
         DATE '9999-12-31', TRUE FROM chg)
"""


def scd2_table(w: Warehouse) -> DataFrame:
    return scd2_apply(scd2_init(initial(w), START), updates(w), "customer_id", TRACKED)


@query("scd2_history", SCD2_SQL + "SELECT * FROM scd2")
def q_scd2_history(spark, d):
    """SCD-5/6/7/13: type 2 initial load, expire changed, insert new versions."""
    return scd2_table(Warehouse(spark, d)).orderBy("customer_id", "effective_date")


@query("scd2_key_histories", SCD2_SQL + """
SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY effective_date) AS version_no
FROM scd2""")
def q_scd2_key_histories(spark, d):
    """SCD-13: the versions of each key, in order and numbered."""
    version = F.row_number().over(Window.partitionBy("customer_id").orderBy("effective_date"))
    return history(scd2_table(Warehouse(spark, d)).withColumn("version_no", version.cast("long")), "customer_id")


@query("scd2_metrics", SCD2_SQL + """
SELECT CAST(COUNT(*) AS BIGINT) AS total_records,
       CAST(COUNT(*) FILTER (WHERE is_current) AS BIGINT) AS current_records,
       CAST(COUNT(*) FILTER (WHERE NOT is_current) AS BIGINT) AS historical_records
FROM scd2""")
def q_scd2_metrics(spark, d):
    """DQ-5: total / current / historical versions in one pass."""
    return history_metrics(scd2_table(Warehouse(spark, d)))


@query("scd2_as_of", SCD2_SQL + """
SELECT * FROM scd2 WHERE DATE '2026-04-05' BETWEEN effective_date AND expiry_date""")
def q_scd2_as_of(spark, d):
    """SCD-11: the dimension as it was on 2026-04-05 (bounds inclusive)."""
    return as_of(scd2_table(Warehouse(spark, d)), dt.date(2026, 4, 5))


@query("scd2_current", SCD2_SQL + "SELECT * FROM scd2 WHERE is_current")
def q_scd2_current(spark, d):
    """SCD-12."""
    return current_rows(scd2_table(Warehouse(spark, d)))


@query("scd2_rerun_unchanged", SCD2_SQL + "SELECT * FROM scd2")
def q_scd2_rerun(spark, d):
    """Applying the same batch a second time changes nothing (idempotent)."""
    w = Warehouse(spark, d)
    return scd2_apply(scd2_table(w), updates(w), "customer_id", TRACKED)


@query("scd3", f"""
WITH {INPUT_SQL},
j AS (SELECT i.*, u.city AS u_city, u.state AS u_state, u.membership AS u_membership, u.segment AS u_segment,
             COALESCE(u.customer_id IS NOT NULL AND i.membership <> u.membership, FALSE) AS ch
      FROM init i LEFT JOIN upd u ON i.customer_id = u.customer_id)
SELECT customer_id, customer_name,
       CASE WHEN ch THEN u_city ELSE city END AS city,
       CASE WHEN ch THEN u_state ELSE state END AS state,
       CASE WHEN ch THEN u_membership ELSE membership END AS current_membership,
       CASE WHEN ch THEN u_segment ELSE segment END AS segment,
       CASE WHEN ch THEN membership ELSE NULL END AS previous_membership
FROM j
""")
def q_scd3(spark, d):
    """SCD-8: type 3 -- previous value column; applied only when the
    membership differs (a move alone is not applied)."""
    w = Warehouse(spark, d)
    dim = scd3_init(initial(w), "membership", "current_membership", "previous_membership")
    return scd3_apply(dim, updates(w), "customer_id", "membership", "current_membership",
                      "previous_membership", also_set=["city", "state", "segment"])


SCD6_SQL = f"""
WITH {INPUT_SQL},
dim AS (SELECT customer_id, customer_name, city, state, segment, membership AS current_membership,
               CAST(NULL AS VARCHAR) AS previous_membership, membership AS historical_membership,
               DATE '2026-01-01' AS effective_date, DATE '9999-12-31' AS expiry_date, TRUE AS is_current FROM init)
"""


@query("scd6", SCD6_SQL + """
SELECT d.customer_id, d.customer_name, d.city, d.state, d.segment, d.current_membership,
       d.previous_membership, d.historical_membership, d.effective_date,
       CASE WHEN c.customer_id IS NULL THEN d.expiry_date ELSE CAST(c.effective_date - 1 AS DATE) END AS expiry_date,
       c.customer_id IS NULL AS is_current
FROM dim d LEFT JOIN chg c ON d.customer_id = c.customer_id
UNION ALL
SELECT c.customer_id, c.customer_name, c.city, c.state, c.segment, c.membership, d.current_membership,
       c.membership, c.effective_date, DATE '9999-12-31', TRUE
FROM chg c JOIN dim d ON c.customer_id = d.customer_id
""")
def q_scd6(spark, d):
    """SCD-9: type 6 -- new version carries current, previous and historical."""
    w = Warehouse(spark, d)
    dim = scd6_init(initial(w), "membership", START)
    return scd6_apply(dim, updates(w), "customer_id", TRACKED, "membership")


HYBRID_SQL = SCD6_SQL + """,
h AS (
  SELECT d.customer_id, d.customer_name, d.city, CAST(NULL AS VARCHAR) AS previous_city, d.state, d.segment,
         d.current_membership, d.previous_membership, d.historical_membership, d.effective_date,
         CASE WHEN c.customer_id IS NULL THEN d.expiry_date ELSE CAST(c.effective_date - 1 AS DATE) END AS expiry_date,
         c.customer_id IS NULL AS is_current
  FROM dim d LEFT JOIN chg c ON d.customer_id = c.customer_id
  UNION ALL
  SELECT c.customer_id, c.customer_name, c.city, d.city, c.state, c.segment, c.membership, d.current_membership,
         c.membership, c.effective_date, DATE '9999-12-31', TRUE
  FROM chg c JOIN dim d ON c.customer_id = d.customer_id),
s AS (SELECT c.customer_id, c.city, c.state, c.membership AS cur_m, d.current_membership AS prev_m,
             d.city AS prev_city, c.city IS DISTINCT FROM d.city AS moved
      FROM chg c JOIN dim d ON c.customer_id = d.customer_id),
hybrid AS (
  SELECT h.customer_id, h.customer_name,
         CASE WHEN s.customer_id IS NULL THEN h.city ELSE s.city END AS city,
         CASE WHEN s.customer_id IS NOT NULL AND s.moved THEN s.prev_city ELSE h.previous_city END AS previous_city,
         CASE WHEN s.customer_id IS NULL THEN h.state ELSE s.state END AS state,
         h.segment,
         CASE WHEN s.customer_id IS NULL THEN h.current_membership ELSE s.cur_m END AS current_membership,
         CASE WHEN s.customer_id IS NULL THEN h.previous_membership ELSE s.prev_m END AS previous_membership,
         h.historical_membership, h.effective_date, h.expiry_date, h.is_current
  FROM h LEFT JOIN s ON h.customer_id = s.customer_id)
"""


def hybrid_table(w: Warehouse) -> DataFrame:
    dim = hybrid_init(initial(w), "membership", START)
    return scd_hybrid_apply(dim, updates(w), "customer_id", TRACKED, "membership", sync=["city", "state"])


@query("scd_hybrid", HYBRID_SQL + "SELECT * FROM hybrid")
def q_scd_hybrid(spark, d):
    """SCD-10: type 2 rows + type 1 sync of city/state/current/previous on
    all versions; previous_city synced only when the city changed."""
    return hybrid_table(Warehouse(spark, d))


@query("scd_hybrid_as_of", HYBRID_SQL + """
SELECT customer_id, customer_name, city, historical_membership, segment, effective_date, expiry_date
FROM hybrid WHERE DATE '2026-03-15' BETWEEN effective_date AND expiry_date""")
def q_scd_hybrid_as_of(spark, d):
    """SCD-11 on the hybrid table: after the sync the city of an old version
    is the new city; only the historical membership is historical."""
    return as_of(hybrid_table(Warehouse(spark, d)), dt.date(2026, 3, 15)).select(
        "customer_id", "customer_name", "city", "historical_membership", "segment",
        "effective_date", "expiry_date")


@query("scd_hybrid_metrics", HYBRID_SQL + """
SELECT CAST(COUNT(*) AS BIGINT) AS total_records,
       CAST(COUNT(*) FILTER (WHERE is_current) AS BIGINT) AS current_records,
       CAST(COUNT(*) FILTER (WHERE NOT is_current) AS BIGINT) AS historical_records
FROM hybrid""")
def q_scd_hybrid_metrics(spark, d):
    return history_metrics(hybrid_table(Warehouse(spark, d)))


@query("history_loss", f"""
WITH {INPUT_SQL}
SELECT u.customer_id, u.membership AS type1_membership, i.membership AS type2_kept_membership,
       i.city AS type2_kept_city, CAST(u.effective_date - 1 AS DATE) AS kept_until
FROM chg u JOIN init i ON u.customer_id = i.customer_id
""")
def q_history_loss(spark, d):
    """SCD-4: what type 1 loses -- for every changed customer the overwritten
    values, which type 2 keeps in its closed version."""
    w = Warehouse(spark, d)
    t1 = scd1_apply(initial(w), updates(w), "customer_id", TRACKED)
    closed = scd2_table(w).filter(~F.col("is_current"))
    return (t1.alias("a").join(closed.alias("b"), "customer_id")
            .select("customer_id", F.col("a.membership").alias("type1_membership"),
                    F.col("b.membership").alias("type2_kept_membership"),
                    F.col("b.city").alias("type2_kept_city"), F.col("b.expiry_date").alias("kept_until")))


# ------------------------------------------------ several updates of a key, late ones, version keys
def second_updates(w: Warehouse, days: int, membership: str) -> DataFrame:
    """Every third updated customer again, ``days`` later, to ``membership``."""
    return (updates(w).filter(F.col("customer_id") % 3 == 0).withColumn("membership", F.lit(membership))
            .withColumn("effective_date", F.date_add("effective_date", days)))


@query("scd1_multi_update", f"""
WITH {INPUT_SQL}
SELECT i.customer_id, i.customer_name, COALESCE(u.city, i.city) AS city, COALESCE(u.state, i.state) AS state,
       CASE WHEN u.customer_id IS NULL THEN i.membership WHEN i.customer_id % 3 = 0 THEN 'BUILDING'
            ELSE u.membership END AS membership,
       COALESCE(u.segment, i.segment) AS segment
FROM init i LEFT JOIN upd u ON i.customer_id = u.customer_id
""")
def q_scd1_multi_update(spark, d):
    """SCD-3 with two updates of a key in one batch: the later one wins."""
    w = Warehouse(spark, d)
    return scd1_apply(initial(w), updates(w).union(second_updates(w, 5, "BUILDING")), "customer_id", TRACKED)


@query("scd3_multi_update", f"""
WITH {INPUT_SQL},
l AS (SELECT customer_id, CASE WHEN customer_id % 3 = 0 THEN 'BUILDING' ELSE membership END AS m FROM upd)
SELECT i.customer_id, i.customer_name, i.city, i.state,
       CASE WHEN l.m <> i.membership THEN l.m ELSE i.membership END AS current_membership, i.segment,
       CASE WHEN l.m <> i.membership THEN i.membership END AS previous_membership
FROM init i LEFT JOIN l ON i.customer_id = l.customer_id
""")
def q_scd3_multi_update(spark, d):
    """SCD-8 with two updates of a key: previous is the value before the batch."""
    w = Warehouse(spark, d)
    dim = scd3_init(initial(w), "membership", "current_membership", "previous_membership")
    return scd3_apply(dim, updates(w).union(second_updates(w, 5, "BUILDING")), "customer_id", "membership",
                      "current_membership", "previous_membership")


@query("scd2_same_day", SCD2_SQL.replace("'HOUSEHOLD' AS membership", """CASE WHEN c.c_custkey % 3 = 0
               THEN 'AUTOMOBILE' ELSE 'HOUSEHOLD' END AS membership""") + "SELECT * FROM scd2")
def q_scd2_same_day(spark, d):
    """SCD-6/7 with two updates of a key on one day: one of them (the smaller
    values) becomes the day's version, and no version ends before it starts."""
    w = Warehouse(spark, d)
    return scd2_apply(scd2_init(initial(w), START), updates(w).union(second_updates(w, 0, "AUTOMOBILE")),
                      "customer_id", TRACKED)


@query("scd2_late_updates", SCD2_SQL + """
SELECT i.customer_id, i.customer_name, i.city, i.state, 'MACHINERY' AS membership, i.segment,
       DATE '2026-02-01' AS effective_date
FROM init i JOIN chg c ON i.customer_id = c.customer_id WHERE i.membership <> 'MACHINERY' AND i.customer_id % 2 = 0
""")
def q_scd2_late_updates(spark, d):
    """SCD-7: corrections dated before the current version started are handed
    out; replayed updates of the batch already applied are not."""
    w = Warehouse(spark, d)
    dim = scd2_apply(scd2_init(initial(w), START), updates(w), "customer_id", TRACKED)
    late = (initial(w).filter(F.col("customer_id") % 2 == 0).withColumn("membership", F.lit("MACHINERY"))
            .withColumn("effective_date", F.lit(dt.date(2026, 2, 1))))
    return late_updates(dim, late.union(updates(w)), "customer_id", TRACKED)


@query("scd2_version_keys", SCD2_SQL + """
SELECT CASE WHEN effective_date = DATE '2026-01-01' THEN CAST(dense_rank() OVER (ORDER BY customer_id) AS BIGINT)
       ELSE (SELECT CAST(COUNT(*) AS BIGINT) FROM init) + CAST(row_number() OVER (
         PARTITION BY effective_date = DATE '2026-01-01' ORDER BY customer_id) AS BIGINT) END AS version_key, *
FROM scd2
""")
def q_scd2_version_keys(spark, d):
    """SCD-5..7 with a key of its own per version: numbered at the initial
    load, continued from the largest one by every apply."""
    w = Warehouse(spark, d)
    dim = scd2_init(assign_keys(initial(w), ["customer_id"], "version_key"), START)
    return scd2_apply(dim, updates(w), "customer_id", TRACKED, version_key="version_key")


# ---------------------------------------------------------------- late updates, versions of facts
def late_batch(w: Warehouse) -> DataFrame:
    """Corrections that arrive after the update batch: customers with a balance
    of at least 6500 become MACHINERY on a day between December 2025 and
    mid-April 2026 (before the first version, inside it, on an update's own day,
    or after it); one column of the dimension is not delivered."""
    c = w.customer.filter(F.col("c_acctbal") >= 6500)
    return c.join(_geo(w), c["c_nationkey"] == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"), F.col("n_name").alias("city"), F.col("r_name").alias("state"),
        F.lit("MACHINERY").alias("membership"), F.lit("Regular").alias("segment"),
        F.date_add(F.lit(dt.date(2025, 12, 1)), (F.col("c_custkey") % 135).cast("int")).alias("effective_date"))


SPLICED_SQL = SCD2_SQL + """,
late AS (SELECT c.c_custkey AS customer_id, g.n_name AS city, g.r_name AS state, 'MACHINERY' AS membership,
                'Regular' AS segment,
                CAST(DATE '2025-12-01' + CAST(c.c_custkey % 135 AS INTEGER) AS DATE) AS effective_date
         FROM customer c JOIN geo g ON c.c_nationkey = g.n_nationkey WHERE c.c_acctbal >= 6500),
ev AS (SELECT s.customer_id, s.customer_name, coalesce(l.city, s.city) AS city, coalesce(l.state, s.state) AS state,
              coalesce(l.membership, s.membership) AS membership, coalesce(l.segment, s.segment) AS segment,
              s.effective_date, FALSE AS is_new
       FROM scd2 s LEFT JOIN late l ON s.customer_id = l.customer_id AND s.effective_date = l.effective_date
       UNION ALL
       SELECT l.customer_id, i.customer_name, l.city, l.state, l.membership, l.segment, l.effective_date, TRUE
       FROM late l JOIN init i USING (customer_id)
       WHERE NOT EXISTS (SELECT 1 FROM scd2 s WHERE s.customer_id = l.customer_id
                                                AND s.effective_date = l.effective_date)),
pv AS (SELECT *, lag((city, state, membership, segment)) OVER k AS before FROM ev
       WINDOW k AS (PARTITION BY customer_id ORDER BY effective_date)),
kept AS (SELECT * FROM pv WHERE NOT (is_new AND before IS NOT NULL
                                     AND before IS NOT DISTINCT FROM (city, state, membership, segment))),
spliced AS (SELECT customer_id, customer_name, city, state, membership, segment, effective_date,
            coalesce(CAST(lead(effective_date) OVER k - 1 AS DATE), DATE '9999-12-31') AS expiry_date,
            lead(effective_date) OVER k IS NULL AS is_current
     FROM kept WINDOW k AS (PARTITION BY customer_id ORDER BY effective_date))
"""


@query("scd2_late_spliced", SPLICED_SQL + "SELECT * FROM spliced")
def q_scd2_late_spliced(spark, d):
    """SCD-6/7: late updates cut the version valid on their day in two; the
    same batch delivered again changes nothing."""
    w = Warehouse(spark, d)
    dim = scd2_table(w)
    for _ in range(2):
        dim = scd2_apply(dim, late_batch(w), "customer_id", TRACKED, late="splice")
    return dim


@query("scd2_late_metrics", SPLICED_SQL + """
SELECT CAST(COUNT(*) AS BIGINT) AS versions, CAST(COUNT(*) FILTER (is_current) AS BIGINT) AS current_rows,
       CAST(COUNT(DISTINCT customer_id) AS BIGINT) AS customers, CAST(0 AS BIGINT) AS overlaps_or_gaps FROM spliced""")
def q_scd2_late_metrics(spark, d):
    """DQ-5 over a spliced history: every version starts the day after the one
    before it ends, and one row a customer is current."""
    w = Warehouse(spark, d)
    dim = scd2_apply(scd2_table(w), late_batch(w), "customer_id", TRACKED, late="splice")
    dim = with_neighbors(dim, ["customer_id"], ["effective_date"], prev_cols=["expiry_date"])
    broken = F.col("_has_prev") & (F.date_add("prev_expiry_date", 1) != F.col("effective_date"))
    return dim.agg(F.count(F.lit(1)).alias("versions"), F.count_if("is_current").alias("current_rows"),
                   F.count_distinct("customer_id").alias("customers"), F.count_if(broken).alias("overlaps_or_gaps"))


FIRST_DAY = dt.date(1995, 7, 1)


def order_time_history(w: Warehouse) -> DataFrame:
    """The customers' versions over the orders' years: known from July 1995 on,
    re-profiled between 1997 and 1999."""
    later = updates(w).withColumn("effective_date", F.date_add(F.lit(dt.date(1997, 1, 1)),
                                                               (F.col("customer_id") % 1000).cast("int")))
    return scd2_apply(scd2_init(initial(w), FIRST_DAY), later, "customer_id", TRACKED)


FACT_VERSION_SQL = f"""
WITH {INPUT_SQL},
ver AS (
  SELECT i.*, DATE '1995-07-01' AS effective_date, CASE WHEN c.customer_id IS NULL THEN DATE '9999-12-31'
         ELSE CAST(DATE '1997-01-01' + CAST(c.customer_id % 1000 AS INTEGER) - 1 AS DATE) END AS expiry_date
  FROM init i LEFT JOIN chg c USING (customer_id)
  UNION ALL SELECT customer_id, customer_name, city, state, membership, segment,
         CAST(DATE '1997-01-01' + CAST(customer_id % 1000 AS INTEGER) AS DATE), DATE '9999-12-31' FROM chg),
f AS (SELECT o.o_orderkey AS sale_id, o.o_custkey AS customer_id, CAST(o.o_orderdate AS DATE) AS sale_date,
             o.o_totalprice AS amount, v.city, v.membership, v.effective_date
      FROM orders o LEFT JOIN ver v ON o.o_custkey = v.customer_id
        AND CAST(o.o_orderdate AS DATE) BETWEEN v.effective_date AND v.expiry_date)
"""


def fact_versions(w: Warehouse) -> DataFrame:
    facts = w.sales().select("sale_id", "customer_id", "sale_date", "amount")
    return as_of_join(facts, order_time_history(w), "customer_id", "sale_date", ["city", "membership", "effective_date"])


@query("fact_as_of_version", FACT_VERSION_SQL + "SELECT * FROM f")
def q_fact_as_of_version(spark, d):
    """SCD-11 x MDL-5: every sale with the customer version valid on its date;
    sales before the first version have none."""
    return fact_versions(Warehouse(spark, d))


@query("revenue_as_of_version", FACT_VERSION_SQL + f"""
SELECT membership, {money_sum_sql('amount')} AS revenue, CAST(COUNT(*) AS BIGINT) AS sales FROM f GROUP BY 1""")
def q_revenue_as_of_version(spark, d):
    """Revenue by the membership that the customer had at the time of sale."""
    return fact_versions(Warehouse(spark, d)).groupBy("membership").agg(
        out_money(money_sum("amount")).alias("revenue"), F.count(F.lit(1)).alias("sales"))


@query("scd2_load_today", f"""
WITH {INPUT_SQL}
SELECT customer_id, membership, CAST(0 AS INTEGER) AS days_since_load, DATE '9999-12-31' AS expiry_date,
       TRUE AS is_current FROM init""")
def q_scd2_load_today(spark, d):
    """FN-6: an initial load whose versions start on the current date."""
    dim = scd2_init(initial(Warehouse(spark, d)), F.current_date())
    return dim.select("customer_id", "membership", F.datediff(F.current_date(), "effective_date").alias("days_since_load"),
                      "expiry_date", "is_current")


@query("scd_hybrid_from_initial", f"""
WITH {INPUT_SQL},
k AS (SELECT i.*, u.city AS u_city, u.state AS u_state, u.segment AS u_segment, c.effective_date AS first_day,
             CASE WHEN i.customer_id % 3 = 0 THEN CAST(u.effective_date + 20 AS DATE) END AS second_day
      FROM init i LEFT JOIN upd u USING (customer_id) LEFT JOIN chg c USING (customer_id)),
t AS (SELECT *, first_day IS NOT NULL OR second_day IS NOT NULL AS touched FROM k),
v AS (SELECT *, 0 AS n, DATE '2026-01-01' AS effective_date, coalesce(first_day, second_day) AS next_day FROM t
      UNION ALL SELECT *, 1, first_day, second_day FROM t WHERE first_day IS NOT NULL
      UNION ALL SELECT *, 2, second_day, NULL FROM t WHERE second_day IS NOT NULL)
SELECT customer_id, customer_name, CASE WHEN touched THEN u_city ELSE city END AS city,
       CASE WHEN n > 0 OR (touched AND u_city IS DISTINCT FROM city) THEN city END AS previous_city,
       CASE WHEN touched THEN u_state ELSE state END AS state, CASE WHEN n > 0 THEN u_segment ELSE segment END AS segment,
       CASE WHEN second_day IS NOT NULL THEN 'BUILDING' WHEN first_day IS NOT NULL THEN 'HOUSEHOLD' ELSE membership END
         AS current_membership,
       CASE WHEN touched THEN membership END AS previous_membership,
       CASE n WHEN 0 THEN membership WHEN 1 THEN 'HOUSEHOLD' ELSE 'BUILDING' END AS historical_membership,
       effective_date, coalesce(CAST(next_day - 1 AS DATE), DATE '9999-12-31') AS expiry_date,
       next_day IS NULL AS is_current
FROM v
""")
def q_scd_hybrid_from_initial(spark, d):
    """SCD-10 over two batches with the previous membership and city taken from
    the initial table each time."""
    w = Warehouse(spark, d)
    dim = hybrid_init(initial(w), "membership", START)
    for batch in (updates(w), second_updates(w, 20, "BUILDING")):
        dim = scd_hybrid_apply(dim, batch, "customer_id", TRACKED, "membership", sync=["city", "state"], first=initial(w))
    return dim
