"""Table-change operators on literal frames."""

from pyspark.sql import functions as F

from tallyspark.operators.changes import (
    change_feed, dedupe_by_key, delete_where, merge_insert_only, new_rows, restore_rows,
    update_from, update_where)
from conftest import rows

SCHEMA = "sale_id int, customer_id int, amount int"


def test_merge_insert_only_and_idempotent(spark):
    t = spark.createDataFrame([(1, 1, 10), (2, 2, 20)], SCHEMA)
    s = spark.createDataFrame([(2, 9, 99), (3, 3, 30), (3, 3, 30), (4, 4, 40)], SCHEMA)
    once = merge_insert_only(t, s, ["sale_id"])
    assert rows(once) == [(1, 1, 10), (2, 2, 20), (3, 3, 30), (4, 4, 40)]
    assert rows(merge_insert_only(once, s, ["sale_id"])) == rows(once)


def test_dedupe_picks_first_by_order(spark):
    s = spark.createDataFrame([(1, 5, 50), (1, 3, 30), (2, 1, 10)], SCHEMA)
    assert rows(dedupe_by_key(s, ["sale_id"], ["customer_id"])) == [(1, 3, 30), (2, 1, 10)]


def test_update_from_reads_old_values(spark):
    t = spark.createDataFrame([(1, "Gold", None), (2, "Silver", None), (3, "Bronze", None)],
                              "id int, cur string, prev string")
    u = spark.createDataFrame([(1, "Platinum"), (2, "Silver")], "id int, m string")
    out = update_from(t, u, ["id"], {"prev": F.col("t.cur"), "cur": F.col("u.m")},
                      condition=F.col("t.cur") != F.col("u.m"))
    assert rows(out) == [(1, "Platinum", "Gold"), (2, "Silver", None), (3, "Bronze", None)]


def test_update_where_and_delete(spark):
    t = spark.createDataFrame([(1, 1, 10), (2, 2, 20), (3, None, 30)], SCHEMA)
    up = update_where(t, F.col("amount") > 15, {"customer_id": F.lit(0), "amount": F.col("amount") + 1})
    assert rows(up) == [(1, 1, 10), (2, 0, 21), (3, 0, 31)]
    # NULL predicate keeps the row
    assert rows(delete_where(t, F.col("customer_id") == 2)) == [(1, 1, 10), (3, None, 30)]


def test_restore_after_delete_is_original_and_safe_twice(spark):
    t = spark.createDataFrame([(1, 1, 10), (2, 2, 20), (10, 5, 100)], SCHEMA)
    pred = F.col("sale_id") == 10
    deleted = delete_where(t, pred)
    once = restore_rows(deleted, t, pred, ["sale_id"])
    assert rows(once) == rows(t)
    assert rows(restore_rows(once, t, pred, ["sale_id"])) == rows(t)


def test_change_feed_actions(spark):
    before = spark.createDataFrame([(1, 1, 10), (2, 2, 20), (3, 3, None)], SCHEMA)
    after = spark.createDataFrame([(1, 1, 10), (2, 2, 25), (3, 3, 30), (4, 4, 40)], SCHEMA)
    feed = change_feed(before, after, ["sale_id"])
    got = rows(feed, "sale_id", "amount", "_action", "_is_update")
    assert got == [(2, 20, "DELETE", True), (2, 25, "INSERT", True),
                   (3, 30, "INSERT", True), (3, None, "DELETE", True), (4, 40, "INSERT", False)]
    assert rows(new_rows(feed)) == [(4, 4, 40)]
    gone = change_feed(after, before, ["sale_id"])
    assert (4, "DELETE", False) in rows(gone, "sale_id", "_action", "_is_update")


def test_change_feed_of_same_table_is_empty(spark):
    t = spark.createDataFrame([(1, 1, 10), (2, None, 20)], SCHEMA)
    assert change_feed(t, t, ["sale_id"]).count() == 0


def test_wide_rows_are_not_broadcast_on_their_count(spark):
    from tallyspark.operators.sizing import broadcast_if_small, proven_light
    df = spark.createDataFrame([(i, "x" * 1000, [1, 2, 3]) for i in range(50)], "k int, text string, a array<int>")
    assert proven_light(df, 100, 60_000) and not proven_light(df, 100, 50_000) and not proven_light(df, 10, 60_000)
    assert broadcast_if_small(df, 100)[1] and not broadcast_if_small(df, 100, max_bytes=50_000)[1]
    assert proven_light(df.limit(0), 0, 0)
