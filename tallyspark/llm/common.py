"""Helpers the operators of this subpackage share: row identity, written
intermediates, key packing, and connected components of a link table."""

from __future__ import annotations

import os

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import ensure_session, scratch_path

#: Bytes of rows that a Python worker gets at a time.  Spark's 64 MB stand in the
#: executor's and the worker's memory several times over, beside its heap.
BATCH_BYTES = 8 << 20
PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ready(spark: SparkSession) -> SparkSession:
    """Session settings, and the package on the Python workers' path (on a
    cluster the package is installed or shipped with ``--py-files``; this
    covers workers started from another folder on the same machine).  Arrow
    batches end at ``BATCH_BYTES``, unless the session has a bound of its own."""
    ensure_session(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) in (None, "67108864b"):  # Spark's default
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    env = spark.sparkContext.environment
    if PACKAGE_ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (PACKAGE_ROOT, env.get("PYTHONPATH")) if x)
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct ``doc``: whatever their names are,
    they cannot clash with those an operator adds beside it."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("doc")


def with_identity(df: DataFrame, *keep: Column) -> DataFrame:
    """``keep`` columns of ``df`` plus ``__f``, ``__r``: which row this is,
    whatever its values.

    A frame read from files takes file and row index, so every evaluation (and
    every retry of a lost task) sees the same identity.  Any other frame falls
    back to ``monotonically_increasing_id``, which repeats only if the frame's
    partitions do."""
    try:
        return df.select(*keep, F.xxhash64(F.col("_metadata.file_path")).alias("__f"),
                         F.col("_metadata.row_index").alias("__r"))
    except AnalysisException:
        return df.select(*keep, F.lit(0).cast("long").alias("__f"), F.monotonically_increasing_id().alias("__r"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new folder below ``spark.checkpoint.dir`` and read
    back: it is computed once and its lineage ends there."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def spread(parts: int, *keys: Column) -> Column:
    """An even bucket number below ``parts`` from the hash of ``keys``."""
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")


def smallest(df: DataFrame, rows: int, *order: str) -> DataFrame:
    """A bounded sample: the ``rows`` rows of smallest ``order``, whose first
    column is an evenly spread 64-bit hash.  Rows far beyond the needed ones
    are left out by their hash before sorting, so what meets in one task is a
    few times ``rows`` however large ``df`` is; the result is the same."""
    share = min(1.0, 8 * rows / max(1, df.count()))
    first = F.col(order[0]).cast("double") <= F.lit((2 * share - 1) * float(1 << 63))
    return df.where(first).orderBy(*order).limit(rows)


# -- links -> components ------------------------------------------------------
def spanning_links(linked: np.ndarray, same: bool) -> list[tuple[int, int]]:
    """Row/column pairs that connect what the boolean matrix ``linked``
    connects: at most one per node, never all pairs.  ``same``: rows and
    columns are the same nodes (a symmetric matrix)."""
    out = []
    n, m = linked.shape
    rows_left = np.ones(n, bool)
    cols_left = rows_left if same else np.ones(m, bool)
    for seed in range(n):
        if not rows_left[seed]:
            continue
        rows_left[seed] = False
        queue = [(seed, True)]
        while queue:
            at, is_row = queue.pop()
            if is_row or same:
                near = np.flatnonzero(linked[at] & cols_left)
                cols_left[near] = False
                out += [(at, int(j)) for j in near]
                queue += [(int(j), same) for j in near]
            else:
                near = np.flatnonzero(linked[:, at] & rows_left)
                rows_left[near] = False
                out += [(int(i), at) for i in near]
                queue += [(int(i), True) for i in near]
    return out


def components(links: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable over ``links`` (columns
    ``a``, ``b``); nodes without a link do not appear.

    Alternating large-star / small-star rounds.  Each round is two minimum
    aggregations (combined before the shuffle) joined back to the links by
    sort-merge, so a node with very many links is split by the skew-join rule;
    every round is written to the shared folder, and only two numbers per round
    reach the driver.  The number of rounds is logarithmic in the longest path."""
    def state(df):
        r = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
        return r.n, r.s

    links = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .where("u <> v").distinct(), name)
    seen = state(links)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low.hint("merge"), "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low.hint("merge"), "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        links = stored(small, name)
        now = state(links)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (links.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
