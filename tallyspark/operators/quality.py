"""Data-quality and reconciliation checks, each a distributed job.

Counts are one-row partial aggregates per table; checks by key are a grouped
count or an anti-join -- nothing is collected to the driver.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.views import materialize

from tallyspark.operators.sizing import BROADCAST_ROWS, proven_small


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str = "duplicate_count") -> DataFrame:
    """Keys occurring more than once, with their count (HAVING count > 1)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
            .filter(F.col(name) > 1))


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
            keep: Sequence[str], max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Fact rows whose foreign key has no dimension row (left anti-join).

    The dimension's key set is broadcast when the dimension's row count (a
    bound on its distinct keys) is proven small, so the fact is streamed
    without a shuffle; otherwise a sort-merge anti-join, where AQE splits a
    skewed fact key."""
    d = dim.select(F.col(dim_key).alias("_dk")).distinct()
    d = F.broadcast(d) if proven_small(dim.select(dim_key), max_rows) else d.hint("merge")
    return fact.join(d, fact[fact_key] == d["_dk"], "left_anti").select(*keep)


def row_counts(tables: Mapping[str, DataFrame], name_col: str = "table_name",
               count_col: str = "row_count") -> DataFrame:
    """One row per table: (name, count)."""
    parts = [df.agg(F.count(F.lit(1)).alias(count_col))
             .select(F.lit(name).alias(name_col), F.col(count_col).cast("long"))
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def audit(tables: Sequence[tuple[str, str, DataFrame]]) -> DataFrame:
    """Tagged audit over models: (schema_type, table_name, row_count)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(model).alias("schema_type"), F.lit(name).alias("table_name"),
                     F.col("row_count").cast("long"))
             for model, name, df in tables]
    return reduce(DataFrame.unionByName, parts).orderBy("schema_type", "table_name")


def history_metrics(dim: DataFrame, flag: str = "is_current") -> DataFrame:
    """Total, current and historical version counts in one pass."""
    return dim.agg(F.count(F.lit(1)).cast("long").alias("total_records"),
                   F.count_if(F.col(flag)).cast("long").alias("current_records"),
                   F.count_if(~F.col(flag)).cast("long").alias("historical_records"))


def rows_touched(tagged: Sequence[tuple[str, DataFrame, Column]]) -> DataFrame:
    """Rows an attribute change must rewrite in each model: (model, rows)."""
    parts = [df.filter(pred).agg(F.count(F.lit(1)).cast("long").alias("rows_touched"))
             .select(F.lit(model).alias("schema_type"), "rows_touched")
             for model, df, pred in tagged]
    return reduce(DataFrame.unionByName, parts)


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], measures: Sequence[str],
              left: str = "a", right: str = "b") -> DataFrame:
    """Full outer join of two report paths on the group key; per measure both
    values and an ``all_match`` flag (NULL-safe equality)."""
    on = reduce(lambda p, q: p & q, [F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}")) for k in keys])
    j = a.withColumn("_in", F.lit(True)).alias("x").join(b.alias("y"), on, "full_outer")
    cols = [F.when(F.col("x._in"), F.col(f"x.{k}")).otherwise(F.col(f"y.{k}")).alias(k) for k in keys]
    checks = []
    for m in measures:
        cols += [F.col(f"x.{m}").alias(f"{left}_{m}"), F.col(f"y.{m}").alias(f"{right}_{m}")]
        checks.append(F.col(f"x.{m}").eqNullSafe(F.col(f"y.{m}")))
    cols.append(reduce(lambda p, q: p & q, checks).alias("all_match"))
    return j.select(*cols)


#: Buckets that two tables are compared by before any row is.
BUCKETS = 4096


def bucket_sums(df: DataFrame, keys: Sequence[str], compare: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Per bucket of the key's hash: rows, and two order-free sums of their
    hashes (one partial row per bucket and task is shuffled)."""
    h = F.xxhash64(*keys, *compare)
    return (df.groupBy(F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket"))
            .agg(F.count(F.lit(1)).alias("rows"), F.sum(F.pmod(h, F.lit((1 << 31) - 1))).alias("hash_sum"),
                 F.bit_xor(h).alias("hash_xor")))


def table_differences(a: DataFrame, b: DataFrame, keys: Sequence[str], compare: Sequence[str] | None = None,
                      buckets: int = BUCKETS) -> DataFrame:
    """(keys, difference): 'only left', 'only right' or 'changed' for every row
    in which two tables with unique ``keys`` differ (NULL-safe).

    Each side is summed up per key bucket where it lies; only the rows of
    buckets whose sums differ are joined.  Two tables that agree shuffle nothing
    but those sums; a few differences shuffle a few buckets."""
    compare = [c for c in (compare or a.columns) if c not in keys]
    left, right = bucket_sums(a, keys, compare, buckets), bucket_sums(b, keys, compare, buckets)
    on = F.col("l.bucket") == F.col("r.bucket")
    unequal = reduce(lambda p, q: p | q, [~F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
                                          for c in ("rows", "hash_sum", "hash_xor")])
    differ = (left.alias("l").join(right.alias("r"), on, "full_outer").filter(unequal)
              .select(F.coalesce("l.bucket", "r.bucket").alias("_bucket")))
    differ = F.broadcast(materialize(differ, "different_buckets"))  # at most ``buckets`` rows

    def part(df: DataFrame, flag: str) -> DataFrame:
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        return (df.select(*keys, *compare, bucket.alias("_bucket")).join(differ, "_bucket", "left_semi")
                .withColumn(flag, F.lit(True)))

    x, y = part(a, "_in_l").alias("x"), part(b, "_in_r").alias("y")
    same_key = reduce(lambda p, q: p & q, [F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}")) for k in keys])
    j = x.join(y, same_key, "full_outer")
    changed = reduce(lambda p, q: p | q, [~F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in compare], F.lit(False))
    kind = (F.when(F.col("_in_r").isNull(), "only left").when(F.col("_in_l").isNull(), "only right")
            .when(changed, "changed"))
    return j.select(*[F.when(F.col("_in_l").isNotNull(), F.col(f"x.{k}")).otherwise(F.col(f"y.{k}")).alias(k)
                      for k in keys], kind.alias("difference")).filter(F.col("difference").isNotNull())
