"""Views and stored (materialized) aggregates.

* A view is a named, lazily re-evaluated plan: ``createOrReplaceTempView``.
  Reading it inlines the plan, so filters and column pruning still reach the
  scans.
* A stored aggregate is written once as Parquet below the shared checkpoint
  folder and read back; a refresh for appended facts merges the stored part
  with the aggregate of the new facts (sums and counts are mergeable) and
  writes a new snapshot folder -- a path is never overwritten while read.
  Under updates and deletes the change feed is the delta: its rows count with
  a sign, so a refresh never reads the facts again.
"""

from __future__ import annotations

import uuid
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import scratch_path


def register_views(spark: SparkSession, views: Mapping[str, DataFrame]) -> list[str]:
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def unique_view_names(spark: SparkSession, views: Mapping[str, DataFrame]) -> dict[str, str]:
    """Register each frame under ``<name>_<unique suffix>`` and return the
    mapping name -> registered name (SQL text is then formatted with it), so
    concurrent callers sharing a session never see each other's views."""
    suffix = uuid.uuid4().hex[:10]
    names = {n: f"{n}_{suffix}" for n in views}
    register_views(spark, {names[n]: df for n, df in views.items()})
    return names


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to a new Parquet folder and return the stored table."""
    spark = df.sparkSession
    target = path or scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def refresh_aggregate(stored: DataFrame, delta: DataFrame, keys: Sequence[str],
                      sum_cols: Sequence[str], name: str) -> DataFrame:
    """Stored grouped sums + grouped sums of the new facts -> new snapshot.
    The union is grouped once more; partial aggregation keeps the shuffle to
    one row per key and task."""
    merged = (stored.select(*keys, *sum_cols).unionByName(delta.select(*keys, *sum_cols))
              .groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sum_cols]))
    return materialize(merged, name)


def signed_delta(feed: DataFrame, keys: Sequence[str], sums: Mapping[str, Column], count: str) -> DataFrame:
    """What the rows of a change feed add to grouped sums and row counts: an
    INSERT counts once, a DELETE minus once (an update is one of each).  ``sums``
    are exact (whole cents), so that what is taken away was once added."""
    sign = F.when(F.col("_action") == "INSERT", 1).otherwise(-1)
    signed = feed.select(*keys, *[(sign * x).alias(c) for c, x in sums.items()], sign.alias(count))
    return signed.groupBy(*keys).agg(*[F.sum(c).cast("long").alias(c) for c in [*sums, count]])


def refresh_signed(stored: DataFrame, delta: DataFrame, keys: Sequence[str], sum_cols: Sequence[str], count: str,
                   name: str) -> DataFrame:
    """Stored grouped sums and row counts + a ``signed_delta`` -> new snapshot.
    A group leaves when its last row does, a new one enters with its first; a
    count below zero (a feed that does not fit the stored rows) fails."""
    cols = [*sum_cols, count]
    merged = (stored.select(*keys, *cols).unionByName(delta.select(*keys, *cols))
              .groupBy(*keys).agg(*[F.sum(c).cast("long").alias(c) for c in cols]))
    fits = F.when(F.col(count) < 0, F.raise_error(F.lit("the feed takes away rows that were never counted"))
                  .cast("boolean")).otherwise(F.col(count) > 0)
    return materialize(merged.filter(fits), name)
