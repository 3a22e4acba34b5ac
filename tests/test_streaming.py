"""Incremental availableNow load: new files only, replay-safe."""

import pytest
from pyspark.sql import functions as F

from tallyspark.session import scratch_path
from tallyspark.streaming.incremental import incremental_load, rejected

SCHEMA = "sale_id long, customer_id long, amount double"


def test_incremental_load_new_files_and_replay(spark):
    table = scratch_path(spark, "t_inc")
    landing = scratch_path(spark, "t_landing")
    spark.createDataFrame([(1, 1, 1.0), (2, 2, 2.0)], SCHEMA).write.parquet(table)
    spark.createDataFrame([(2, 9, 9.0), (3, 3, 3.0), (3, 3, 3.0)], SCHEMA).coalesce(1).write.parquet(landing + "/a")
    schema = spark.read.parquet(table).schema
    ckpt = scratch_path(spark, "t_ckpt")
    out = incremental_load(spark, landing + "/a", schema, table, ["sale_id"], ckpt)
    assert sorted(tuple(r) for r in out.collect()) == [(1, 1, 1.0), (2, 2, 2.0), (3, 3, 3.0)]
    # second run: no new files -> unchanged
    again = incremental_load(spark, landing + "/a", schema, table, ["sale_id"], ckpt)
    assert again.count() == 3
    # replay of every file (fresh checkpoint, as after a lost checkpoint): unchanged
    replay = incremental_load(spark, landing + "/a", schema, table, ["sale_id"], scratch_path(spark, "t_ckpt2"))
    assert replay.count() == 3
    assert replay.filter(F.col("sale_id") == 2).first().customer_id == 2


def test_csv_rejects_null_keys_and_replay(spark):
    table, landing = scratch_path(spark, "t_inc"), scratch_path(spark, "t_landing")
    spark.createDataFrame([(1, 1, 1.0)], SCHEMA).write.parquet(table)
    spark.createDataFrame([("sale_id,customer_id,amount",), ("2,2,2.5",), ("x,3,3.0",), (",4,4.0",), ("5,null,",),
                           ("6,6",)], "value string").coalesce(1).write.text(landing)
    schema = spark.read.parquet(table).schema
    for ckpt in ("t_ckpt3", "t_ckpt3", "t_ckpt4"):
        out = incremental_load(spark, landing, schema, table, ["sale_id"], scratch_path(spark, ckpt), file_format="csv")
    assert sorted(map(tuple, out.collect())) == [(1, 1, 1.0), (2, 2, 2.5), (5, None, None)]
    assert {r[0] for r in rejected(spark, table).collect()} == {"x,3,3.0", ",4,4.0", "6,6"}
    with pytest.raises(Exception, match="bad row"):
        incremental_load(spark, landing, schema, table, ["sale_id"], scratch_path(spark, "t_ckpt5"),
                         file_format="csv", on_error="abort")
