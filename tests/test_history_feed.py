"""Late versions, facts tied to versions, the consumed feed and the signed
refresh on literal frames."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyspark.operators.changes import change_feed
from tallyspark.operators.ordered import carry_forward
from tallyspark.operators.scd import as_of_join, scd2_apply, scd2_init, splice_late
from tallyspark.operators.views import refresh_signed, signed_delta
from tallyspark.streaming.feed import append_changes, consume, consumed, read_feed
from conftest import rows

OPEN = dt.date(9999, 12, 31)


def day(n):
    return dt.date(2026, 1, 1) + dt.timedelta(days=n)


@pytest.fixture(params=["small", "at scale"])
def sized(spark, request):
    if request.param == "at scale":
        spark.conf.set("tallyspark.sizing.maxRows", "0")
    yield request.param
    spark.conf.unset("tallyspark.sizing.maxRows")


def history_of(spark):
    dim = scd2_init(spark.createDataFrame([(1, "Ann", "Silver"), (2, "Bob", "Gold"), (3, "Cy", None)],
                                          "id int, name string, tier string"), day(10))
    upd = spark.createDataFrame([(1, "Ann", "Gold", day(50))], "id int, name string, tier string, effective_date date")
    return scd2_apply(dim, upd, "id", ["tier"])


def test_late_versions_are_spliced_in(spark, sized):
    late = spark.createDataFrame([
        (1, "Bronze", day(30)),   # inside the first version
        (1, "Bronze", day(35)),   # equal to the one before it
        (1, "Iron", day(40)), (1, "Steel", day(5)),  # a second cut, and before the first version
        (1, "Platinum", day(50)),  # a version's own first day
        (2, "Gold", day(10)), (3, "Tin", day(2)), (9, "Lead", day(1)),  # no news, older, unknown key
        (2, "Gold", day(8))], "id int, tier string, effective_date date")
    dim = history_of(spark).cache()
    want = [(1, "Ann", "Steel", day(5), day(9), False), (1, "Ann", "Silver", day(10), day(29), False),
            (1, "Ann", "Bronze", day(30), day(39), False), (1, "Ann", "Iron", day(40), day(49), False),
            (1, "Ann", "Platinum", day(50), OPEN, True),
            (2, "Bob", "Gold", day(8), day(9), False), (2, "Bob", "Gold", day(10), OPEN, True),
            (3, "Cy", "Tin", day(2), day(9), False), (3, "Cy", None, day(10), OPEN, True)]
    once = splice_late(dim, late, "id", ["tier"])
    assert sorted(map(tuple, once.collect()), key=lambda r: (r[0], r[3])) == want
    again = splice_late(once, late, "id", ["tier"])
    assert sorted(map(tuple, again.collect()), key=lambda r: (r[0], r[3])) == want


def test_splice_then_apply_keeps_both_kinds(spark):
    upd = spark.createDataFrame([(1, "Bronze", day(50)), (1, "Gold", day(60)), (9, "Lead", day(1))],
                                "id int, tier string, effective_date date")
    got = scd2_apply(history_of(spark), upd, "id", ["tier"], late="splice").where("id in (1, 9)")
    assert sorted(map(tuple, got.collect()), key=lambda r: (r[0], r[3])) == [
        (1, "Ann", "Silver", day(10), day(49), False), (1, "Ann", "Bronze", day(50), day(59), False),
        (1, "Ann", "Gold", day(60), OPEN, True), (9, None, "Lead", day(1), OPEN, True)]


def test_spliced_versions_get_new_keys(spark):
    dim = history_of(spark).withColumn("v", F.when(F.col("is_current"), 10).otherwise(1).cast("long") + F.col("id"))
    late = spark.createDataFrame([(2, "Tin", day(20)), (2, "Zinc", day(3))], "id int, tier string, effective_date date")
    got = splice_late(dim, late, "id", ["tier"], version_key="v").where("id = 2")
    assert sorted((r.effective_date, r.tier, r.v, r.is_current) for r in got.collect()) == [
        (day(3), "Zinc", 14, False), (day(10), "Gold", 12, True)]


def test_carry_forward_over_any_cut(spark):
    rng = random.Random(2)
    data = [(rng.choice([1, 1, 1, 1, 2, 3, None]), rng.randrange(60), i, rng.choice([None, None, None, f"v{i}"]))
            for i in range(400)]
    df = spark.createDataFrame(data, "k int, d int, i int, v string")
    want, last = [], {}
    for k, d, i, v in sorted(data, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2])):
        if v is not None and k is not None:
            last[k] = v
        want.append((i, None if k is None else last.get(k)))
    for parts in (1, 3, 17):
        got = carry_forward(df, ["k"], ["d", "i"], "v", "out", num_partitions=parts)
        assert sorted((r.i, r.out) for r in got.collect()) == sorted(want)


def test_facts_take_the_version_of_their_day(spark, sized):
    rng = random.Random(3)
    versions = [(k, day(100 * n), day(100 * n + (49 if n == 2 else 99)), f"{k}-{n}", k) for k in (1, 2) for n in range(4)]
    dim = spark.createDataFrame(versions, "id int, effective_date date, expiry_date date, tier string, kind int")
    facts = [(i, rng.choice([1, 1, 1, 1, 2, 7, None]), rng.choice([day(rng.randrange(-20, 450)), None, day(100)]))
             for i in range(300)]

    def version(k, d):
        hit = [v for v in versions if v[0] == k and d is not None and v[1] <= d <= v[2]]
        return hit[0][3] if hit else None

    got = as_of_join(spark.createDataFrame(facts, "n int, id int, sold date"), dim, "id", "sold", ["tier"])
    assert got.columns == ["n", "id", "sold", "tier"]
    assert sorted((r.n, r.tier) for r in got.collect()) == sorted((n, version(k, d)) for n, k, d in facts)


def test_feed_consumers_have_their_own_offset(spark, tmp_path):
    states = [spark.createDataFrame(s, "k int, v string") for s in
              ([(1, "a"), (2, "b")], [(1, "a"), (2, "c"), (3, "d")], [(2, "c"), (3, "d")])]
    feed, sink = str(tmp_path / "feed"), str(tmp_path / "sink")
    table = states[0].schema

    def read(name, **more):
        return rows(consume(spark, feed, table, str(tmp_path / name), sink, **more), "k", "v", "_action", "_change")

    append_changes(change_feed(states[0], states[1], ["k"]), feed, 1)
    first = [(2, "b", "DELETE", 1), (2, "c", "INSERT", 1), (3, "d", "INSERT", 1)]
    assert read("a") == first and read("a") == []
    for _ in range(2):
        append_changes(change_feed(states[1], states[2], ["k"]), feed, 2)
    second = [(1, "a", "DELETE", 2)]
    assert read("a") == second and read("a") == [] and read("b") == sorted(first + second)
    assert read("c", keep=F.col("_action") == "DELETE") == [(1, "a", "DELETE", 2), (2, "b", "DELETE", 1)]
    assert read_feed(spark, feed, table).count() == 4
    schema = read_feed(spark, feed, table).schema
    assert consumed(spark, sink, schema).count() == 10


def test_signed_refresh(spark):
    stored = spark.createDataFrame([("x", 300, 2), ("y", 50, 1)], "g string, cents long, n long")
    before = spark.createDataFrame([(1, "x", 100), (2, "x", 200), (3, "y", 50)], "k int, g string, c long")
    after = spark.createDataFrame([(1, "x", 150), (2, "z", 200), (4, None, 7)], "k int, g string, c long")
    delta = signed_delta(change_feed(before, after, ["k"]), ["g"], {"cents": F.col("c")}, "n")
    got = refresh_signed(stored, delta, ["g"], ["cents"], "n", "refreshed")
    assert rows(got) == [("x", 150, 1), ("z", 200, 1), (None, 7, 1)]
    empty = signed_delta(change_feed(after, after, ["k"]), ["g"], {"cents": F.col("c")}, "n")
    assert rows(refresh_signed(got, empty, ["g"], ["cents"], "n", "refreshed")) == rows(got)
    with pytest.raises(Exception, match="never counted"):
        refresh_signed(got, delta, ["g"], ["cents"], "n", "refreshed").collect()
