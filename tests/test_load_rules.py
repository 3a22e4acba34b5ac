"""Partitioned load with rules, continued running sums, table differences and
hot-key joins on literal frames."""

import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.operators.ordered import continue_running_total, running_state, running_total
from tallyspark.operators.quality import table_differences
from tallyspark.operators.sizing import hot_key_join, hot_keys
from tallyspark.streaming.partitioned import (
    BROKEN, PART, ForeignKey, Rules, broken_rows, folder_width, key_range, load_with_constraints, read_partitioned,
    write_partitioned)
from conftest import rows

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("g", T.IntegerType()),
                       T.StructField("v", T.StringType())])


def load(spark, tmp_path, data, rules, name):
    landing = str(tmp_path / f"landing-{name}")
    spark.createDataFrame(data, SCHEMA).repartition(2).write.parquet(landing)
    return load_with_constraints(spark, landing, SCHEMA, str(tmp_path / "table"), rules, key_range("k", 100),
                                 str(tmp_path / f"ckpt-{name}"))


def test_a_batch_reads_only_the_folders_it_touches(spark, tmp_path):
    path = str(tmp_path / "table")
    write_partitioned(spark.createDataFrame([(1, 1, "a"), (150, 1, "b"), (950, 1, "z")], SCHEMA), path, key_range("k", 100))
    spoiled = os.path.join(path, f"{PART}=7", "part-0.parquet")  # a folder that no batch below touches
    os.makedirs(os.path.dirname(spoiled))
    with open(spoiled, "w") as f:
        f.write("not a Parquet file")
    got = load(spark, tmp_path, [(1, 9, "again"), (2, 1, "c"), (151, 1, "d"), (2, 1, "c")], Rules(["k"]), "x")
    kept = read_partitioned(spark, path, SCHEMA).filter(F.col(PART).isin(0, 1, 9)).select("k", "g", "v")
    assert rows(kept) == [(1, 1, "a"), (2, 1, "c"), (150, 1, "b"), (151, 1, "d"), (950, 1, "z")]
    with pytest.raises(Exception):
        got.collect()  # the whole table holds the spoiled file


def test_rules_name_everything_a_row_breaks(spark, tmp_path):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    rules = Rules(["k"], [ForeignKey("no group", ["g"], parent, ["id"])], {"short": F.length("v") < 3})
    data = [(1, 1, "a"), (None, 1, "b"), (2, 9, "long text"), (3, 1, "x"), (3, 1, "y"), (4, None, None), (5, 2, "e"),
            (5, 2, "e"), (None, 9, "also long")]
    for name in ("first", "replay"):
        got = load(spark, tmp_path, data, rules, name)
        assert rows(got) == [(1, 1, "a"), (4, None, None), (5, 2, "e")]
    bad = broken_rows(spark, str(tmp_path / "table"), SCHEMA).select("k", "v", F.array_join(BROKEN, "+").alias("b"))
    want = {(None, "b", "missing key"), (2, "long text", "no group+short"), (3, "x", "duplicate key"),
            (3, "y", "duplicate key"), (None, "also long", "missing key+no group+short")}
    assert set(map(tuple, bad.collect())) == want and bad.count() == 2 * len(want)


@pytest.fixture
def four_tasks(spark):
    """Every shuffle keeps its four tasks, however little they hold."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_batch_adds_few_files_to_many_folders(four_tasks, tmp_path):
    data = [(i, 1, f"v{i % 5}") for i in range(0, 5000, 5)]
    got = load(four_tasks, tmp_path, data, Rules(["k"]), "x")
    assert rows(got) == data
    folders = glob.glob(f"{tmp_path}/table/{PART}=*")
    files = glob.glob(f"{tmp_path}/table/{PART}=*/*.parquet")
    assert len(folders) == 50 and len(files) <= 50 + 4  # not one for each task and folder


def test_a_folder_with_most_rows_is_written_by_several_tasks(four_tasks, tmp_path):
    data = [(i, 1, "v") for i in range(1000)] + [(10 ** 6, 1, "far")]
    write_partitioned(four_tasks.createDataFrame(data, SCHEMA), str(tmp_path / "t"), key_range("k", 10 ** 5))
    assert len(glob.glob(f"{tmp_path}/t/{PART}=0/*.parquet")) > 1
    assert rows(read_partitioned(four_tasks, str(tmp_path / "t"), SCHEMA).drop(PART)) == data


def test_folder_width_follows_the_table(spark):
    df = spark.createDataFrame([(0, 1, "a"), (2_559_999, 1, "b"), (None, 1, "c")], SCHEMA)
    assert folder_width(df, "k") == 10_000 and folder_width(df, "k", least=20_000) == 20_000
    assert folder_width(df.limit(0), "k", least=7) == 7


def test_running_sum_in_parts_equals_one(spark):
    data = [(i // 3, i, (i * 7) % 11 - 3 if i % 5 else None) for i in range(90)]
    df = spark.createDataFrame(data, "d int, i int, c long")
    whole = rows(running_total(df, ["d", "i"], "c", "t"))
    first = running_total(df.filter("d < 10"), ["d", "i"], "c", "t")
    second = continue_running_total(running_state(first, ["d", "i"], "t"), df.filter("d >= 10 and d < 20"), ["d", "i"], "c", "t")
    third = continue_running_total(running_state(second, ["d", "i"], "t"), df.filter("d >= 20"), ["d", "i"], "c", "t")
    assert rows(first.union(second).union(third)) == whole
    none = running_state(df.limit(0).withColumn("t", F.lit(0).cast("long")), ["d", "i"], "t")
    assert rows(continue_running_total(none, df, ["d", "i"], "c", "t")) == whole
    with pytest.raises(Exception, match="not later"):
        continue_running_total(running_state(second, ["d", "i"], "t"), df.filter("d = 19"), ["d", "i"], "c", "t").collect()


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_table_differences(spark, buckets):
    a = [(i, "x", i * 2 if i % 7 else None) for i in range(200)] + [(None, "n", 1)]
    b = [r for r in a if r[0] != 5] + [(900, "new", 1)]
    b = [(k, v, 77) if k == 14 else (k, "y", n) if k == 20 else (k, v, n) for k, v, n in b]
    x, y = (spark.createDataFrame(t, "k int, v string, n int") for t in (a, b))
    assert rows(table_differences(x, y, ["k"], buckets=buckets)) == [
        (5, "only left"), (14, "changed"), (20, "changed"), (900, "only right")]
    assert table_differences(x, x.select("k", "n", "v"), ["k"], buckets=buckets).count() == 0
    assert table_differences(x, x.limit(0), ["k"], buckets=buckets).count() == 201


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_key_join_equals_a_plain_join(spark, how):
    big = spark.createDataFrame([(1 if i % 2 else i % 50, i) for i in range(600)] + [(None, -1), (77, -2)], "k int, i int")
    dim = spark.createDataFrame([(k, f"n{k}") for k in range(50)], "id int, name string")
    assert [r.k for r in hot_keys(big, "k", 0.1).collect()] == [1]
    plain = rows(big.join(dim, F.col("k") == F.col("id"), how))
    spark.conf.set("tallyspark.sizing.maxRows", "0")
    try:
        for share in (0.1, 0.9):
            assert rows(hot_key_join(big, dim, "k", "id", how, share=share)) == plain
    finally:
        spark.conf.unset("tallyspark.sizing.maxRows")
    assert rows(hot_key_join(big, dim, "k", "id", how)) == plain
