"""Slowly changing dimensions on a five-customer literal fixture."""

import datetime as dt

from pyspark.sql import functions as F

from tallyspark.operators import scd
from tallyspark.operators.quality import history_metrics
from tallyspark.operators.scd import (
    as_of, attribute_changes, changed_rows, current_rows, hybrid_init, scd1_apply, scd2_apply, scd2_init,
    scd3_apply, scd3_init, scd6_apply, scd6_init, scd_hybrid_apply)
from conftest import rows

D = dt.date
TRACKED = ["city", "state", "membership", "segment"]
COLS = "customer_id int, customer_name string, city string, state string, membership string, segment string"


def initial(spark):
    return spark.createDataFrame([
        (1, "Ana", "Lyon", "ARA", "Silver", "Regular"), (2, "Ben", "Nice", "PACA", "Gold", "Premium"),
        (3, "Cleo", "Metz", "GE", "Silver", "Regular"), (4, "Dan", "Lyon", "ARA", "Gold", "Premium"),
        (5, "Eve", "Brest", "BZH", "Bronze", "Regular")], COLS)


def updates(spark, extra=()):
    return spark.createDataFrame([
        (1, "Ana", "Paris", "IDF", "Gold", "Premium", D(2026, 4, 1)),
        (3, "Cleo", "Lille", "HDF", "Gold", "Premium", D(2026, 4, 5)),
        (4, "Dan", "Lyon", "ARA", "Platinum", "Premium", D(2026, 4, 10)), *extra],
        COLS + ", effective_date date")


def test_changed_rows_and_attribute_diff(spark):
    ch = changed_rows(initial(spark), updates(spark).drop("effective_date"), "customer_id", TRACKED)
    assert [r.customer_id for r in ch.orderBy("customer_id").collect()] == [1, 3, 4]
    long = attribute_changes(initial(spark), updates(spark), "customer_id", TRACKED)
    per_key = {k: n for k, n in long.groupBy("customer_id").count().collect()}
    assert per_key == {1: 4, 3: 4, 4: 1}


def test_type1_overwrites(spark):
    out = scd1_apply(initial(spark), updates(spark), "customer_id", TRACKED)
    assert out.count() == 5
    assert rows(out.filter("customer_id = 1"), "city", "membership") == [("Paris", "Gold")]


def test_type2(spark):
    dim = scd2_apply(scd2_init(initial(spark), "2026-01-01"), updates(spark), "customer_id", TRACKED)
    m = history_metrics(dim).first()
    assert (m.total_records, m.current_records, m.historical_records) == (8, 5, 3)
    exp = {r.customer_id: r.expiry_date for r in dim.filter(~F.col("is_current")).collect()}
    assert exp == {1: D(2026, 3, 31), 3: D(2026, 4, 4), 4: D(2026, 4, 9)}
    past = as_of(dim, "2026-03-15").filter("customer_id = 1").first()
    assert (past.membership, past.city) == ("Silver", "Lyon")
    assert current_rows(dim).count() == 5


def test_type2_invariants_chain_unknown_and_rerun(spark):
    extra = [(5, "Eve", "Brest", "BZH", "Gold", "Regular", D(2026, 5, 1)),
             (5, "Eve", "Brest", "BZH", "Platinum", "Regular", D(2026, 6, 1)),
             (2, "Ben", "Nice", "PACA", "Gold", "Premium", D(2026, 4, 2)),      # no change
             (6, "Fay", "Caen", "NOR", "Bronze", "Regular", D(2026, 4, 3))]     # new key
    dim0 = scd2_init(initial(spark), "2026-01-01")
    dim = scd2_apply(dim0, updates(spark, extra), "customer_id", TRACKED)
    five = [(r.effective_date, r.expiry_date, r.is_current)
            for r in dim.filter("customer_id = 5").orderBy("effective_date").collect()]
    assert five == [(D(2026, 1, 1), D(2026, 4, 30), False), (D(2026, 5, 1), D(2026, 5, 31), False),
                    (D(2026, 6, 1), D(9999, 12, 31), True)]
    assert dim.filter("customer_id = 2").count() == 1
    assert dim.filter("customer_id = 6 and is_current").count() == 1
    # one current row per key; next effective = expiry + 1
    assert dim.groupBy("customer_id").agg(F.count_if("is_current").alias("c")).filter("c <> 1").count() == 0
    for k in range(1, 7):
        vs = dim.filter(F.col("customer_id") == k).orderBy("effective_date").collect()
        for a, b in zip(vs, vs[1:]):
            assert b.effective_date == a.expiry_date + dt.timedelta(days=1)
    again = scd2_apply(dim, updates(spark, extra), "customer_id", TRACKED)
    assert rows(again) == rows(dim)


def test_type3(spark):
    dim = scd3_init(initial(spark), "membership", "current_membership", "previous_membership")
    out = scd3_apply(dim, updates(spark), "customer_id", "membership", "current_membership",
                     "previous_membership", also_set=["city", "state", "segment"])
    got = {r.customer_id: (r.current_membership, r.previous_membership) for r in out.collect()}
    assert got == {1: ("Gold", "Silver"), 2: ("Gold", None), 3: ("Gold", "Silver"),
                   4: ("Platinum", "Gold"), 5: ("Bronze", None)}
    assert out.filter("customer_id = 1").first().customer_name == "Ana"


def test_type6(spark):
    dim = scd6_apply(scd6_init(initial(spark), "membership", "2026-01-01"), updates(spark),
                     "customer_id", TRACKED, "membership")
    assert dim.count() == 8 and dim.filter("is_current").count() == 5
    new = dim.filter("customer_id = 1 and is_current").first()
    old = dim.filter("customer_id = 1 and not is_current").first()
    assert (new.current_membership, new.previous_membership, new.historical_membership) == ("Gold", "Silver", "Gold")
    assert (old.current_membership, old.previous_membership, old.historical_membership) == ("Silver", None, "Silver")


def test_hybrid_sync(spark):
    dim = scd_hybrid_apply(hybrid_init(initial(spark), "membership", "2026-01-01"), updates(spark),
                           "customer_id", TRACKED, "membership", sync=["city", "state"])
    assert (dim.count(), dim.filter("is_current").count()) == (8, 5)
    past = as_of(dim, "2026-03-15").filter("customer_id = 1").first()
    assert (past.historical_membership, past.city, past.current_membership) == ("Silver", "Paris", "Gold")
    assert past.previous_city == "Lyon"
    four = {r.is_current: r.previous_city for r in dim.filter("customer_id = 4").collect()}
    assert four == {False: None, True: "Lyon"}   # city unchanged: no previous_city sync


def test_with_neighbors_large_path_matches_window(spark):
    from pyspark.sql import Window
    from tallyspark.operators.ordered import with_neighbors
    import random
    rnd = random.Random(3)
    # one key holds a third of the rows
    data = [(0 if i % 3 == 0 else rnd.randint(1, 50), i, rnd.randint(0, 9)) for i in range(1500)]
    df = spark.createDataFrame(data, "k int, t int, v int")
    got = with_neighbors(df, ["k"], ["t"], prev_cols=["v"], next_cols=["t"], small_rows=0)
    w = Window.partitionBy("k").orderBy("t")
    ref = df.select("*", F.lag("v").over(w).alias("prev_v"), F.lead("t").over(w).alias("next_t"))
    assert rows(got, "k", "t", "prev_v", "next_t") == rows(ref, "k", "t", "prev_v", "next_t")
    assert got.filter("not _has_prev").count() == df.select("k").distinct().count()


def test_type2_chain_large_path(spark, monkeypatch):
    import tallyspark.operators.ordered as O
    import tallyspark.operators.scd as S
    extra = [(5, "Eve", "Brest", "BZH", "Gold", "Regular", D(2026, 5, 1)),
             (5, "Eve", "Brest", "BZH", "Platinum", "Regular", D(2026, 6, 1))]
    want = rows(scd2_apply(scd2_init(initial(spark), "2026-01-01"), updates(spark, extra), "customer_id", TRACKED))
    # force the large-batch path: no proven bound, neighbours by sequence joins
    monkeypatch.setattr(S, "_small_batch", lambda upd: False)
    monkeypatch.setattr(O, "proven_small", lambda df, n: False)
    big = scd2_apply(scd2_init(initial(spark), "2026-01-01"), updates(spark, extra), "customer_id", TRACKED)
    assert rows(big) == want


def test_several_updates_of_a_key(spark):
    """Types 1 and 3 take the latest update; type 2 takes one a day, and no
    version ends before it starts."""
    import datetime as dtm
    d = dtm.date
    dim = spark.createDataFrame([(1, "Pune", "Silver")], "k long, city string, membership string")
    upd = spark.createDataFrame([(1, "Agra", "Platinum", d(2026, 5, 1)), (1, "Zurich", "Gold", d(2026, 4, 1)),
                                 (1, "Bern", "Gold", d(2026, 4, 1))],
                                "k long, city string, membership string, effective_date date")
    assert scd1_apply(dim, upd, "k", ["city"]).first().city == "Agra"
    t3 = scd3_init(dim, "membership", "current_membership", "previous_membership")
    assert scd3_apply(t3, upd, "k", "membership", "current_membership", "previous_membership"
                      ).first().current_membership == "Platinum"
    t2 = scd2_apply(scd2_init(dim, "2026-01-01"), upd, "k", ["city", "membership"]).collect()
    assert len(t2) == 3 and sum(r.is_current for r in t2) == 1
    assert all(r.effective_date <= r.expiry_date for r in t2)


def test_a_large_batch_sends_no_rows_to_the_driver(spark, monkeypatch):
    dim = scd.scd2_init(spark.createDataFrame([(i, f"n{i}", "a") for i in range(20)], "id int, name string, city string"),
                        "2026-01-01")
    upd = spark.createDataFrame([(i, "b", dt.date(2025 + i % 2, 6, 1)) for i in range(5, 25)],
                                "id int, city string, effective_date date")
    want = rows(scd.scd2_apply(dim, upd, "id", ["city"], late="splice"))
    monkeypatch.setattr(scd, "SMALL_ROWS", 1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = scd.scd2_apply(dim, upd, "id", ["city"], late="splice")
        assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
        assert rows(got) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
