"""Surrogate keys over several loads."""

from pyspark.sql import types as T

from tallyspark.operators.keys import KeyRegistry, keys_to_add, load_levels
from conftest import rows


def registry(spark, tmp_path, name, key, natural):
    return KeyRegistry(spark, str(tmp_path / name), key, T.StructType.fromDDL(natural))


def test_keys_stay_and_new_names_follow(spark, tmp_path):
    r = registry(spark, tmp_path, "r", "k", "name string")
    assert r.rows().count() == 0
    r.load(spark.createDataFrame([("FRANCE",), ("INDIA",), ("INDIA",)], "name string"), "1")
    assert rows(r.rows()) == [(1, "FRANCE"), (2, "INDIA")]
    r.load(spark.createDataFrame([("CHINA",), (None,), ("INDIA",), (None,)], "name string"), "2")
    want = [(1, "FRANCE"), (2, "INDIA"), (3, "CHINA"), (4, None)]
    assert rows(r.rows()) == want
    for load in ("2", "3"):  # a replay and another delivery of the same names
        r.load(spark.createDataFrame([("CHINA",), (None,), ("FRANCE",)], "name string"), load)
    assert rows(r.rows()) == want and r.rows(with_load=True).where("_load = '3'").count() == 0
    r.load(spark.createDataFrame([], "name string"), "4")
    assert rows(r.rows()) == want


def test_unknown_names_resolve_to_null_and_no_row_is_lost(spark, tmp_path):
    r = registry(spark, tmp_path, "r", "k", "name string")
    r.load(spark.createDataFrame([("A",), (None,)], "name string"), "1")
    df = spark.createDataFrame([(10, "A"), (11, "B"), (12, None), (13, "A")], "id int, name string")
    assert rows(r.resolve(df)) == [(1, 10), (1, 13), (2, 12), (None, 11)]


def test_composite_natural_key_without_small_sides(spark):
    held = spark.createDataFrame([(7, "x", 1), (9, "x", None)], "k long, name string, parent int")
    new = spark.createDataFrame([("x", 1), ("x", None), ("x", 2), ("a", 5), ("a", 5)], "name string, parent int")
    want = [(10, "a", 5), (11, "x", 2)]
    assert rows(keys_to_add(held, new, ["name", "parent"], "k")) == want
    spark.conf.set("tallyspark.sizing.maxRows", "0")
    try:
        assert rows(keys_to_add(held, new, ["name", "parent"], "k")) == want
    finally:
        spark.conf.unset("tallyspark.sizing.maxRows")


def test_levels_keep_their_keys_under_new_parents(spark, tmp_path):
    levels = [registry(spark, tmp_path, "c", "category_key", "category string"),
              registry(spark, tmp_path, "b", "brand_key", "brand string, category_key bigint")]
    src = "brand string, category string"
    load_levels(levels, spark.createDataFrame([("Acme", "Video"), ("Bolt", "Video")], src), "1")
    load_levels(levels, spark.createDataFrame([("Acme", "Audio"), ("Acme", "Video"), ("Aero", "Video")], src), "2")
    assert rows(levels[0].rows()) == [(1, "Video"), (2, "Audio")]
    assert rows(levels[1].rows()) == [(1, "Acme", 1), (2, "Bolt", 1), (3, "Acme", 2), (4, "Aero", 1)]
