"""Dimensional model and report helpers on literal frames."""

import datetime as dt

from pyspark.sql import functions as F

from tallyspark.operators.model import build_level, calendar, resolve_parent
from tallyspark.operators.reports import (
    Lookup, Measure, above_average, money_m, purchase_frequency, revenue_by, top_by, with_global_avg)
from conftest import rows


def test_level_keeps_name_per_parent(spark):
    src = spark.createDataFrame([("Acme", "Audio"), ("Acme", "Video"), ("Bolt", "Audio"), ("Acme", "Audio")],
                                "brand string, category string")
    cat = build_level(src, ["category"], "category_key")
    brand = build_level(src, ["brand"], "brand_key", parent=(cat, ["category"], "category_key"))
    assert rows(cat) == [(1, "Audio"), (2, "Video")]
    assert rows(brand) == [(1, "Acme", 1), (2, "Acme", 2), (3, "Bolt", 1)]


def test_resolve_parent_hands_out_unmatched(spark):
    lv = spark.createDataFrame([(1, "North"), (2, "South")], "k long, name string")
    src = spark.createDataFrame([(10, "North"), (11, "East")], "id int, name string")
    ok, miss = resolve_parent(src, lv, ["name"], "k")
    assert rows(ok) == [(10, 1)] and rows(miss) == [(11, "East")]


def test_calendar_attributes(spark):
    d = spark.createDataFrame([(dt.datetime(2026, 7, 1),), (dt.datetime(2026, 7, 31),)], "ts timestamp")
    cal = calendar(d, "ts")
    assert cal.count() == 31
    first = cal.filter("day = 1").first()
    assert (first.date_key, first.day_name, first.week_no, first.month, first.quarter, first.is_weekend) == \
        (20260701, "Wednesday", 27, "July", "Q3", "No")
    assert cal.filter("is_weekend = 'Yes'").count() == 8


def test_revenue_by_preaggregates_to_same_result(spark):
    fact = spark.createDataFrame([(1, 10, 1.10), (1, 10, 2.20), (2, 20, 3.30), (3, 99, 1.00)],
                                 "sale int, cust int, amount double")
    dim = spark.createDataFrame([(10, "A", "X"), (20, "B", "X")], "cust_id int, name string, grp string")
    got = revenue_by(fact, ["grp"], [money_m("revenue", "amount"), Measure("n", "rows")],
                     [Lookup(dim, "cust", "cust_id")])
    assert rows(got) == [("X", 6.6, 3)]   # sale 3 has no customer: inner look-up drops it


def test_purchase_frequency_keeps_zero(spark):
    cust = spark.createDataFrame([(1, "A"), (2, "B")], "c int, name string")
    sales = spark.createDataFrame([(100, 1), (101, 1)], "s int, c2 int")
    assert rows(purchase_frequency(cust, sales, "c", "c2", "s")) == [(1, "A", 2), (2, "B", 0)]
    assert rows(purchase_frequency(cust, sales, "c", "c2", "s", keep_zero=False)) == [(1, "A", 2)]


def test_top_by_tie_breaks_on_key(spark):
    g = spark.createDataFrame([(3, 5.0), (1, 5.0), (2, 4.0)], "k int, v double")
    assert [r.k for r in top_by(g, "v", ["k"], 2).collect()] == [1, 3]
    assert [tuple(r) for r in top_by(g, "v", ["k"], 3, numbered="rn").orderBy("rn").collect()] == \
        [(1, 5.0, 1), (3, 5.0, 2), (2, 4.0, 3)]


def test_above_average_is_exact_and_avg_rounds_half_up(spark):
    g = spark.createDataFrame([(1, 100), (2, 200), (3, 301)], "k int, cents long")
    assert [r.k for r in above_average(g, "cents").collect()] == [3]   # avg 200.33
    avg = with_global_avg(spark.createDataFrame([(1, 1), (2, 2)], "k int, cents long"), "cents", "a")
    assert {r.a for r in avg.collect()} == {0.02}   # 1.5 cents -> 2 cents


def _sales_frames(spark):
    fact = spark.createDataFrame([(1, 10, 1.10), (2, 10, 2.20), (3, 20, 3.30), (4, 30, 4.40), (5, 99, 1.00)],
                                 "sale int, cust int, amount double")
    dim = spark.createDataFrame([(10, "A", 1), (20, "B", 2), (30, "C", 1)], "cust_id int, name string, reg int")
    reg = spark.createDataFrame([(1, "North"), (2, "South")], "reg_id int, region string")
    return fact, dim, reg


def test_revenue_by_broadcast_and_shuffle_paths_agree(spark):
    """Look-ups proven small are joined before aggregating; otherwise the fact
    is pre-aggregated by key first.  Same report either way, also with a
    chained look-up and with a mix of both kinds."""
    fact, dim, reg = _sales_frames(spark)
    ms = [money_m("revenue", "amount"), Measure("n", "rows")]

    def run(**kw):
        small_dim, small_reg = kw.get("dim"), kw.get("reg")
        return rows(revenue_by(fact, ["region"], ms,
                               [Lookup(dim, "cust", "cust_id", small=small_dim),
                                Lookup(reg, "reg", "reg_id", small=small_reg)],
                               broadcast_rows=kw.get("bound", 1000)))

    expected = [("North", 7.7, 3), ("South", 3.3, 1)]   # sale 5 has no customer
    assert run() == expected                            # both proven small
    assert run(bound=0) == expected                     # neither provable
    assert run(dim=False, reg=True) == expected         # big first, small second


def test_revenue_by_small_lookup_does_not_shuffle_the_fact_by_key(spark):
    fact, dim, _ = _sales_frames(spark)
    out = revenue_by(fact, ["name"], [money_m("revenue", "amount")], [Lookup(dim, "cust", "cust_id")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "hashpartitioning(cust" not in plan


def test_date_hierarchy_keeps_names_apart_per_year(spark):
    """Quarter and month names repeat every year; the levels resolve them by
    name *and* parent key, so July 2025 and July 2026 are different months."""
    from types import SimpleNamespace

    from tallyspark.plans.model import NormalizedDates

    orders = spark.createDataFrame([(dt.datetime(2025, 7, 15),), (dt.datetime(2026, 7, 15),)],
                                   "o_orderdate timestamp")
    nd = NormalizedDates(SimpleNamespace(orders=orders))
    assert nd.year.count() == 2
    assert nd.quarter.count() == 5                     # Q3, Q4 of 2025; Q1-Q3 of 2026
    assert nd.month.count() == 13                      # July 2025 .. July 2026
    assert nd.month.filter("month_name = 'July'").count() == 2
    days = nd.date_dim()
    assert days.count() == 366
    july = days.filter("date_key in (20250715, 20260715)").select("month_key").distinct().count()
    assert july == 2


def test_revenue_by_dimension_grain_aggregates_before_joining(spark):
    """Grouped by the dimension key: the fact is aggregated by its own key
    first, then the proven-small dimension is broadcast-joined."""
    fact, dim, _ = _sales_frames(spark)
    out = revenue_by(fact, ["cust_id", "name"], [money_m("revenue", "amount")],
                     [Lookup(dim, "cust", "cust_id")])
    assert rows(out) == [(10, "A", 3.3), (20, "B", 3.3), (30, "C", 4.4)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    # the aggregate below the join is keyed on the fact's key alone
    assert plan.index("BroadcastHashJoin") < plan.rindex("HashAggregate(keys=[cust#")


def test_report_edges(spark):
    """Totals beyond a bigint product, negative averages, NULL groups."""
    from pyspark.sql import functions as F

    from tallyspark.functions.columns import avg_money_from_cents
    from tallyspark.operators.quality import reconcile
    from tallyspark.operators.reports import above_average
    big = spark.createDataFrame([(1, 4 * 10 ** 18), (2, 10 ** 18), (3, 5)], "k long, c long")
    assert [r.k for r in above_average(big, "c").collect()] == [1]
    got = spark.createDataFrame([(-302, 3), (302, 3), (-5, 2)], "t long, n long").select(
        avg_money_from_cents("t", "n").alias("a")).collect()
    assert [r.a for r in got] == [-1.01, 1.01, -0.03]
    a = spark.createDataFrame([(None, 1), ("x", 2)], "g string, v long")
    rows = reconcile(a, a.select(F.col("g").alias("g"), (F.col("v") + 0).alias("v")), ["g"], ["v"]).collect()
    assert len(rows) == 2 and all(r.all_match for r in rows)
