"""Table-change scenarios on the orders table (CHG-1..CHG-9, DQ-7).

The scenario is a sales table loaded up to 1999-12-31 (``history``), then a
staging batch of everything shipped from 1999-07-01 on (overlapping the
history, with orders of January 2001 delivered twice), merged insert-only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.columns import cents, out_cents
from tallyspark.operators.changes import (
    ACTION, IS_UPDATE, change_feed, clone_table, delete_where, diverged, merge_insert_only, new_rows,
    restore_rows, rows_to_insert, update_from, update_where)
from tallyspark.operators.quality import duplicate_keys, orphans, row_counts
from tallyspark.operators.sizing import split_by_keys
from tallyspark.operators.views import materialize, refresh_signed, signed_delta
from tallyspark.plans.registry import cents_sql, query
from tallyspark.session import scratch_path
from tallyspark.sources.sinks import NamedTable
from tallyspark.sources.tables import Warehouse
from tallyspark.streaming.feed import append_changes, consume, consumed

ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def _ts(s: str):
    return F.lit(s).cast("timestamp")


def history(w: Warehouse) -> DataFrame:
    return w.orders.filter(F.col("o_orderdate") < _ts("2000-01-01 00:00:00"))


def staging(w: Warehouse) -> DataFrame:
    o = w.orders
    batch = o.filter(F.col("o_orderdate") >= _ts("1999-07-01 00:00:00"))
    redelivered = o.filter((F.col("o_orderdate") >= _ts("2001-01-01 00:00:00"))
                           & (F.col("o_orderdate") < _ts("2001-02-01 00:00:00")))
    return batch.unionByName(redelivered)


HIST_SQL = "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'"
STAGE_SQL = """SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1999-07-01 00:00:00'
  UNION ALL SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01 00:00:00'
                                   AND o_orderdate < TIMESTAMP '2001-02-01 00:00:00'"""
MERGED_SQL = f"""SELECT * FROM ({HIST_SQL}) UNION ALL
  SELECT DISTINCT s.* FROM ({STAGE_SQL}) s
  WHERE s.o_orderkey NOT IN (SELECT o_orderkey FROM ({HIST_SQL}))"""


def merged(w: Warehouse) -> DataFrame:
    return merge_insert_only(history(w), staging(w), ["o_orderkey"])


@query("merge_insert_only", MERGED_SQL)
def q_merge_insert_only(spark, d):
    """CHG-1: new keys appended, matched rows untouched, duplicates reduced."""
    return merged(Warehouse(spark, d))


@query("merge_twice_unchanged", MERGED_SQL)
def q_merge_twice(spark, d):
    """CHG-1 idempotence: merging the same staging batch again changes nothing."""
    w = Warehouse(spark, d)
    once = materialize(merged(w), "orders_merged")
    return merge_insert_only(once, staging(w), ["o_orderkey"])


# "mark orders fulfilled when every line has shipped": source derived from lineitem
FULFILLED_SQL = """SELECT l_orderkey FROM lineitem GROUP BY l_orderkey
  HAVING MIN(l_linestatus) = 'F' AND MAX(l_linestatus) = 'F'"""


@query("update_from", f"""
SELECT o.o_orderkey, o.o_custkey,
       CASE WHEN f.l_orderkey IS NOT NULL THEN 'F' ELSE o.o_orderstatus END AS o_orderstatus,
       o.o_totalprice, o.o_orderdate, o.o_orderpriority
FROM orders o LEFT JOIN ({FULFILLED_SQL}) f ON o.o_orderkey = f.l_orderkey
""")
def q_update_from(spark, d):
    """CHG-2: ``update orders set status='F' from (orders whose lines all
    shipped) where key matches``.  The source is one row per order."""
    w = Warehouse(spark, d)
    done = (w.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(F.min("l_linestatus").alias("lo"), F.max("l_linestatus").alias("hi"))
            .filter((F.col("lo") == "F") & (F.col("hi") == "F")).select("o_orderkey"))
    return update_from(w.orders, done, ["o_orderkey"], {"o_orderstatus": F.lit("F")})


@query("update_in_list", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN '3-MEDIUM' ELSE o_orderpriority END
         AS o_orderpriority
FROM orders
""")
def q_update_in_list(spark, d):
    """CHG-3 with FLT-4: rows whose priority is in a list get another one."""
    w = Warehouse(spark, d)
    return update_where(w.orders, F.col("o_orderpriority").isin("4-NOT SPECIFIED", "5-LOW"),
                        {"o_orderpriority": F.lit("3-MEDIUM")})


@query("update_where", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN o_orderstatus = 'O' AND o_totalprice > 400000 THEN '1-URGENT' ELSE o_orderpriority END
         AS o_orderpriority
FROM orders
""")
def q_update_where(spark, d):
    """CHG-3: escalate large open orders."""
    o = Warehouse(spark, d).orders
    return update_where(o, (F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 400000),
                        {"o_orderpriority": F.lit("1-URGENT")})


PURGE_SQL = "o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '1996-01-01 00:00:00'"


def _purge(o: DataFrame):
    return (F.col("o_orderstatus") == "P") & (F.col("o_orderdate") < _ts("1996-01-01 00:00:00"))


@query("delete_where", f"SELECT * FROM orders WHERE NOT ({PURGE_SQL})")
def q_delete_where(spark, d):
    """CHG-4: purge old pending orders."""
    o = Warehouse(spark, d).orders
    return delete_where(o, _purge(o))


@query("restore_deleted", "SELECT * FROM orders")
def q_restore_deleted(spark, d):
    """CHG-5: delete, then restore the deleted rows from the snapshot taken
    before the delete (run twice to show it is safe): the original table."""
    w = Warehouse(spark, d)
    before = w.orders
    after_delete = materialize(delete_where(before, _purge(before)), "orders_after_delete")
    once = restore_rows(after_delete, before, _purge(before), ["o_orderkey"])
    return restore_rows(once, before, _purge(before), ["o_orderkey"])


@query("clone_diverged", f"""
SELECT 'original' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM ({HIST_SQL})
UNION ALL
SELECT 'clone', CAST(COUNT(*) AS BIGINT) FROM ({MERGED_SQL})
UNION ALL
SELECT 'clone_only', CAST(COUNT(*) AS BIGINT) FROM ({MERGED_SQL}) m
  WHERE m.o_orderkey NOT IN (SELECT o_orderkey FROM ({HIST_SQL}))
""")
def q_clone_diverged(spark, d):
    """CHG-6 + DQ-7: clone the history table, merge the staging batch into the
    clone only; the original keeps its rows."""
    w = Warehouse(spark, d)
    original = materialize(history(w), "orders_original")
    clone = clone_table(original, "orders_clone")
    clone2 = materialize(merge_insert_only(clone, staging(w), ["o_orderkey"]), "orders_clone_v2")
    return row_counts({"original": original, "clone": clone2,
                       "clone_only": diverged(original, clone2, ["o_orderkey"])})


def _after(w: Warehouse) -> DataFrame:
    """After = merged, then large open orders escalated, old pending purged."""
    m = merged(w)
    m = update_where(m, (F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 400000),
                     {"o_orderpriority": F.lit("1-URGENT")})
    return delete_where(m, _purge(m))


AFTER_SQL = f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  CASE WHEN o_orderstatus = 'O' AND o_totalprice > 400000 THEN '1-URGENT' ELSE o_orderpriority END AS o_orderpriority
  FROM ({MERGED_SQL}) WHERE NOT ({PURGE_SQL})"""

FEED_SQL = f"""
WITH b AS ({HIST_SQL}), a AS ({AFTER_SQL})
SELECT a.*, 'INSERT' AS _action, FALSE AS _is_update FROM a WHERE a.o_orderkey NOT IN (SELECT o_orderkey FROM b)
UNION ALL
SELECT b.*, 'DELETE', FALSE FROM b WHERE b.o_orderkey NOT IN (SELECT o_orderkey FROM a)
UNION ALL
SELECT b.*, 'DELETE', TRUE FROM b JOIN a ON a.o_orderkey = b.o_orderkey
  WHERE a.o_orderpriority IS DISTINCT FROM b.o_orderpriority OR a.o_orderstatus IS DISTINCT FROM b.o_orderstatus
     OR a.o_totalprice IS DISTINCT FROM b.o_totalprice OR a.o_custkey IS DISTINCT FROM b.o_custkey
     OR a.o_orderdate IS DISTINCT FROM b.o_orderdate
UNION ALL
SELECT a.*, 'INSERT', TRUE FROM b JOIN a ON a.o_orderkey = b.o_orderkey
  WHERE a.o_orderpriority IS DISTINCT FROM b.o_orderpriority OR a.o_orderstatus IS DISTINCT FROM b.o_orderstatus
     OR a.o_totalprice IS DISTINCT FROM b.o_totalprice OR a.o_custkey IS DISTINCT FROM b.o_custkey
     OR a.o_orderdate IS DISTINCT FROM b.o_orderdate
"""


@query("change_feed", FEED_SQL)
def q_change_feed(spark, d):
    """CHG-7: net change feed of the sales table between the history snapshot
    and the state after merge + escalation + purge."""
    w = Warehouse(spark, d)
    return change_feed(history(w), _after(w), ["o_orderkey"])


@query("new_rows_count", f"""
SELECT CAST(COUNT(*) AS BIGINT) AS new_rows FROM ({FEED_SQL}) WHERE _action = 'INSERT' AND NOT _is_update
""")
def q_new_rows_count(spark, d):
    """CHG-8: number of newly inserted rows reported by the feed."""
    w = Warehouse(spark, d)
    return new_rows(change_feed(history(w), _after(w), ["o_orderkey"])).agg(
        F.count(F.lit(1)).cast("long").alias("new_rows"))


@query("change_feed_empty", """
SELECT CAST(COUNT(*) AS BIGINT) AS feed_rows FROM orders WHERE FALSE
""")
def q_change_feed_empty(spark, d):
    """change_feed(t, t) is empty."""
    o = Warehouse(spark, d).orders
    return change_feed(o, o, ["o_orderkey"]).agg(F.count(F.lit(1)).cast("long").alias("feed_rows"))


@query("append_batch", MERGED_SQL)
def q_append_batch(spark, d):
    """SNK-1: the history is written as a table; the rows of the staging batch
    that are new (anti-join, duplicates reduced) are appended by name with a
    cast to the table's types; the table is read back."""
    from tallyspark.sources.sinks import append
    w = Warehouse(spark, d)
    path = scratch_path(spark, "sales_append")
    hist = history(w)
    hist.write.parquet(path)
    table = spark.read.parquet(path)
    new = rows_to_insert(table, staging(w), ["o_orderkey"])
    return append(new.select(*reversed(new.columns)), path, hist.schema)


@query("insert_literal_row", """
SELECT * FROM orders UNION ALL
SELECT CAST(-1 AS BIGINT), CAST(0 AS BIGINT), 'O', 3000.0, TIMESTAMP '2026-07-11 00:00:00', '3-MEDIUM'
""")
def q_insert_literal_row(spark, d):
    """SNK-2 / SRC-7: a literal row (implicit casts from text and ints) inserted
    into a clone of the whole table."""
    import datetime as dtm
    from tallyspark.sources.sinks import align, literal_rows
    w = Warehouse(spark, d)
    clone = clone_table(w.orders, "orders_clone_literal")
    row = literal_rows(spark, [(-1, 0, "O", 3000, dtm.datetime(2026, 7, 11), "3-MEDIUM")],
                       "o_orderkey int, o_custkey int, o_orderstatus string, o_totalprice int, "
                       "o_orderdate timestamp, o_orderpriority string")
    return clone.unionByName(align(row, clone.schema))


# ---------------------------------------------------------------- consumed feed, signed refresh
def _read_summary(rows: DataFrame, consumer: str, read_no: int) -> DataFrame:
    inserted, updated = F.col(ACTION) == "INSERT", F.col(IS_UPDATE)
    return rows.agg(
        F.count(F.lit(1)).alias("feed_rows"), F.count_if(inserted & ~updated).alias("inserted"),
        F.count_if(inserted & updated).alias("updated"), F.count_if(~inserted & ~updated).alias("deleted"),
        F.coalesce(F.sum(cents("o_totalprice")), F.lit(0)).cast("long").alias("cents"),
    ).select(F.lit(consumer).alias("consumer"), F.lit(read_no).alias("read_no"), "*")


FEEDS_SQL = f"""
WITH h AS ({HIST_SQL}), m AS ({MERGED_SQL}), a AS ({AFTER_SQL}),
f1 AS (SELECT m.*, 'INSERT' AS _action, FALSE AS _is_update FROM m WHERE m.o_orderkey NOT IN (SELECT o_orderkey FROM h)),
f2 AS (SELECT m.*, 'DELETE' AS _action, FALSE AS _is_update FROM m WHERE m.o_orderkey NOT IN (SELECT o_orderkey FROM a)
       UNION ALL SELECT m.*, 'DELETE', TRUE FROM m JOIN a USING (o_orderkey) WHERE m.o_orderpriority <> a.o_orderpriority
       UNION ALL SELECT a.*, 'INSERT', TRUE FROM m JOIN a USING (o_orderkey) WHERE m.o_orderpriority <> a.o_orderpriority),
r AS (SELECT 'A' AS consumer, 1 AS read_no, * FROM f1 UNION ALL SELECT 'A', 2, * FROM f2
      UNION ALL SELECT 'B', 1, * FROM f1 UNION ALL SELECT 'B', 1, * FROM f2),
e AS (SELECT * FROM (VALUES ('A', 1), ('A', 2), ('A', 3), ('B', 1)) t(consumer, read_no))
"""


def _stored_states(w: Warehouse) -> list[DataFrame]:
    return [materialize(s, f"feed_state{i}") for i, s in enumerate((history(w), merged(w), _after(w)))]


@query("feed_two_consumers", FEEDS_SQL + f"""
SELECT e.consumer, e.read_no, CAST(COUNT(_action) AS BIGINT) AS feed_rows,
       CAST(COUNT(*) FILTER (_action = 'INSERT' AND NOT _is_update) AS BIGINT) AS inserted,
       CAST(COUNT(*) FILTER (_action = 'INSERT' AND _is_update) AS BIGINT) AS updated,
       CAST(COUNT(*) FILTER (_action = 'DELETE' AND NOT _is_update) AS BIGINT) AS deleted,
       CAST(COALESCE(SUM({cents_sql('o_totalprice')}), 0) AS BIGINT) AS cents
FROM e LEFT JOIN r ON e.consumer = r.consumer AND e.read_no = r.read_no GROUP BY ALL
""")
def q_feed_two_consumers(spark, d):
    """CHG-7: two changes are appended to the feed (the second one delivered
    twice).  Consumer A reads after each of them and once more, when nothing is
    new; consumer B reads everything at once, at its own offset."""
    states = _stored_states(Warehouse(spark, d))
    feed, table = scratch_path(spark, "orders_feed"), states[0].schema
    offset = {c: scratch_path(spark, f"feed_offset_{c}") for c in "AB"}
    sink = scratch_path(spark, "feed_sink")

    def read(consumer, n):
        return _read_summary(consume(spark, feed, table, offset[consumer], sink), consumer, n)

    append_changes(change_feed(states[0], states[1], ["o_orderkey"]), feed, 1)
    first = read("A", 1)
    for _ in range(2):
        append_changes(change_feed(states[1], states[2], ["o_orderkey"]), feed, 2)
    return first.unionByName(read("A", 2)).unionByName(read("B", 1)).unionByName(read("A", 3))


@query("feed_new_orders", FEEDS_SQL + """
SELECT o_orderkey, o_custkey, o_totalprice, 1::BIGINT AS _change FROM f1
""")
def q_feed_new_orders(spark, d):
    """CHG-8: a consumer that keeps the newly inserted rows only; its table
    holds each of them once however often it reads."""
    states = _stored_states(Warehouse(spark, d))
    feed, table = scratch_path(spark, "orders_feed"), states[0].schema
    offset, sink = scratch_path(spark, "feed_offset"), scratch_path(spark, "feed_new_orders")
    for n in (1, 2):
        append_changes(change_feed(states[n - 1], states[n], ["o_orderkey"]), feed, n)
        for _ in range(2):
            got = consume(spark, feed, table, offset, sink, keep=(F.col(ACTION) == "INSERT") & ~F.col(IS_UPDATE))
    return consumed(spark, sink, got.schema, ["o_orderkey", "o_custkey", "o_totalprice", "_change"])


@query("materialized_after_changes", f"""
WITH m AS ({MERGED_SQL}),
u AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_custkey + 1 ELSE o_custkey END AS o_custkey,
             CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM m),
a AS (SELECT * FROM u WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0))
SELECT o_custkey, CAST(SUM({cents_sql('o_totalprice')}) / 100.0 AS DOUBLE) AS revenue,
       CAST(COUNT(*) AS BIGINT) AS orders FROM a GROUP BY 1
""")
def q_materialized_after_changes(spark, d):
    """VIW-2: revenue and orders per customer, stored for the history, then
    refreshed three times from the change feed alone: a merge (new groups), an
    update that doubles amounts and moves orders to another customer, and a
    delete of all orders of some customers (their groups leave)."""
    w = Warehouse(spark, d)
    closed = w.customer.filter(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))
    states = [materialize(history(w), "refresh_state0"), materialize(merged(w), "refresh_state1")]
    pending = F.col("o_orderstatus") == "P"
    states.append(materialize(update_where(states[1], pending, {
        "o_custkey": F.col("o_custkey") + 1, "o_totalprice": F.col("o_totalprice") * 2}), "refresh_state2"))
    states.append(materialize(split_by_keys(states[2], closed, ["o_custkey"])[1], "refresh_state3"))
    sums, keys = {"cents": cents("o_totalprice")}, ["o_custkey"]
    stored = materialize(states[0].groupBy(*keys).agg(F.sum(sums["cents"]).alias("cents"),
                                                      F.count(F.lit(1)).alias("orders")), "customer_revenue0")
    for before, after in zip(states, states[1:]):
        feed = change_feed(before, after, ["o_orderkey"])
        stored = refresh_signed(stored, signed_delta(feed, keys, sums, "orders"), keys, ["cents"], "orders",
                                "customer_revenue")
    return stored.select("o_custkey", out_cents("cents").alias("revenue"), "orders")


@query("create_or_replace_followed", f"""
SELECT 'first' AS version, CAST(COUNT(*) AS BIGINT) AS row_count, CAST(SUM({cents_sql('o_totalprice')}) AS BIGINT) AS cents
FROM ({HIST_SQL})
UNION ALL SELECT 'newest', CAST(COUNT(*) AS BIGINT), CAST(SUM({cents_sql('o_totalprice')}) AS BIGINT) FROM ({MERGED_SQL})
""")
def q_create_or_replace_followed(spark, d):
    """SNK-3: a table created from the history and replaced by the merged state,
    read from itself; the name follows, a reader of the first content keeps it."""
    w = Warehouse(spark, d)
    table = NamedTable(spark, scratch_path(spark, "orders_named"), w.orders.schema)
    opened = table.replace(history(w))
    table.replace(merge_insert_only(table.read(), staging(w), ["o_orderkey"]))

    def totals(df, name):
        return df.agg(F.count(F.lit(1)).alias("row_count"), F.sum(cents("o_totalprice")).alias("cents")).select(
            F.lit(name).alias("version"), "*")

    return totals(opened, "first").unionByName(totals(table.read(), "newest"))


@query("duplicate_staging_orders", """
SELECT o_orderkey, CAST(2 AS BIGINT) AS duplicate_count FROM orders
WHERE o_orderdate >= TIMESTAMP '2001-01-01 00:00:00' AND o_orderdate < TIMESTAMP '2001-02-01 00:00:00'
""")
def q_duplicate_staging_orders(spark, d):
    """DQ-1 with hits: the orders that the staging batch delivers twice."""
    return duplicate_keys(staging(Warehouse(spark, d)), ["o_orderkey"])


@query("orphan_staging_orders", f"""
SELECT s.o_orderkey, s.o_custkey FROM ({STAGE_SQL}) s
WHERE s.o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01 00:00:00')
""")
def q_orphan_staging_orders(spark, d):
    """DQ-2 with hits: staged orders of customers that the first load (customers
    with orders before 1996) does not know."""
    w = Warehouse(spark, d)
    known = w.orders.filter(F.col("o_orderdate") < _ts("1996-01-01 00:00:00")).select("o_custkey").distinct()
    return orphans(staging(w), known, "o_custkey", "o_custkey", ["o_orderkey", "o_custkey"])
