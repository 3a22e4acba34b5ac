"""Incremental load into a partitioned table: a merge that reads only the part
of the target its batch touches, and checks the batch's rules in the same pass.

The target lies in folders by one column that the key determines (a key range,
``key_range``; or a date that a key never changes).  A micro-batch is reduced to
one row per key and stored; the partitions it names are a bounded list (one
value each), by which the target's scan is pruned to those folders, so what a
batch reads does not grow with the rest of the table.

Rows are cut into ranges of (folder, row hash) before they are written: a task
then writes the folders of its range and no others, so a write makes at most one
file a folder and one a task, not one for each pair of them, and a folder that
holds most rows is cut over several tasks.  ``folder_width`` sizes the key
ranges by the table, so the number of folders grows by rows, not by keys.

Rules are checked on the batch alone, against stored keys where they need them:
a missing key, a key delivered twice with different rows, a foreign key whose
parent is unknown, a predicate that does not hold.  Every offending row goes to
the side table once, with the names of all rules it breaks; a replayed batch
overwrites its side folder and adds nothing to the target.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import md5
from typing import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.operators.changes import dedupe_by_key, keys_absent
from tallyspark.operators.sizing import lookup_join
from tallyspark.operators.views import materialize

PART = "_part"
BROKEN = "_broken"
#: A batch that touches more folders than this reads the table without a list.
MAX_LISTED = 10_000
#: Folders that a table is spread over, and the rows of an average folder
#: beyond which it gets more.
FOLDERS, FOLDER_ROWS = 256, 1_000_000


def key_range(key: str, width: int) -> Column:
    """The number of the range of ``width`` keys that ``key`` lies in."""
    return F.floor(F.col(key) / width).cast("long")


def folder_width(table: DataFrame, key: str, least: int = 1) -> int:
    """The width of the key ranges (at least ``least``) that spread the whole
    numbers ``key`` of ``table`` over ``FOLDERS`` folders, or over as many as
    hold ``FOLDER_ROWS`` rows on average.  It stays a table's for good."""
    low, high, rows = table.agg(F.min(key), F.max(key), F.count(key)).first()
    if not rows:
        return least
    return max(least, -(-(high - low + 1) // max(FOLDERS, rows // FOLDER_ROWS)))


@dataclass(frozen=True)
class ForeignKey:
    """``columns`` of a row must be found as ``parent_keys`` of ``parent``
    (NULLs refer to nothing and pass)."""
    name: str
    columns: Sequence[str]
    parent: DataFrame
    parent_keys: Sequence[str]


@dataclass(frozen=True)
class Rules:
    """What a batch must meet: not-NULL ``keys`` that are unique, foreign keys,
    and predicates by name (NULL counts as met, as in a CHECK constraint)."""
    keys: Sequence[str]
    foreign: Sequence[ForeignKey] = ()
    checks: Mapping[str, Column] | None = None

    def broken(self, batch: DataFrame) -> DataFrame:
        """``batch`` plus ``_broken``: the names of the rules a row breaks.
        Rows that are equal in every column are one delivery, not duplicates."""
        rest = [c for c in batch.columns if c not in self.keys]
        one = F.count_distinct(F.struct(*[F.col(c) for c in rest])) if rest else F.lit(1)
        twice = batch.groupBy(*self.keys).agg(one.alias("_n")).filter("_n > 1").select(
            *[F.col(k).alias(f"_d_{k}") for k in self.keys], F.lit(True).alias("_twice"))
        out = lookup_join(batch, twice, [F.col(k) == F.col(f"_d_{k}") for k in self.keys], "left")
        missing = F.lit(False)
        for k in self.keys:
            missing = missing | F.col(k).isNull()
        names = [F.when(missing, F.lit("missing key")), F.when(F.col("_twice"), F.lit("duplicate key"))]
        for i, fk in enumerate(self.foreign):
            wanted = batch.select(*fk.columns).distinct()
            known = fk.parent.select(*[F.col(p).alias(c) for p, c in zip(fk.parent_keys, fk.columns, strict=True)])
            lost = keys_absent(wanted, known, list(fk.columns)).select(
                *[F.col(c).alias(f"_p{i}_{c}") for c in fk.columns], F.lit(True).alias(f"_lost{i}"))
            out = lookup_join(out, lost, [F.col(c) == F.col(f"_p{i}_{c}") for c in fk.columns], "left")
            names.append(F.when(F.col(f"_lost{i}"), F.lit(fk.name)))
        names += [F.when(~F.coalesce(p, F.lit(True)), F.lit(n)) for n, p in (self.checks or {}).items()]
        return out.select(*batch.columns, F.filter(F.array(*names), lambda x: x.isNotNull()).alias(BROKEN))


def append_folders(df: DataFrame, path: str) -> None:
    """Adds the rows of ``df`` (with ``_part``) to their folders below ``path``:
    new files, at most one a folder and one a task."""
    atomic = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in atomic])
    df.repartitionByRange(PART, spread).write.mode("append").partitionBy(PART).parquet(path)


def write_partitioned(df: DataFrame, path: str, part: Column) -> None:
    """``df`` as a table below ``path``, in folders by ``part``."""
    append_folders(df.withColumn(PART, part), path)


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table with its ``_part`` column, empty if nothing is stored yet."""
    full = T.StructType([*schema.fields, T.StructField(PART, T.LongType())])
    try:
        return spark.read.schema(full).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], full)


def touched_part(table: DataFrame, batch: DataFrame) -> DataFrame:
    """The rows of ``table`` in the folders that ``batch`` (with ``_part``)
    names; the scan lists and reads no others."""
    parts = [r[0] for r in batch.select(PART).distinct().limit(MAX_LISTED + 1).collect()]
    if len(parts) > MAX_LISTED:
        return table.join(batch.select(PART).distinct(), PART, "left_semi")
    return table.filter(F.col(PART).isin(parts)) if parts else table.filter(F.lit(False))


def load_with_constraints(spark: SparkSession, landing_dir: str, schema: T.StructType, path: str, rules: Rules,
                          part: Column, checkpoint: str, max_files_per_batch: int | None = None,
                          order: Sequence[str] = (), side: str | None = None) -> DataFrame:
    """Merges the Parquet files that arrived in ``landing_dir`` insert-only into
    the partitioned table at ``path``.  Rows that break a rule go to ``side``
    (default: the table's path plus ``-broken``).  Returns the table."""
    stream = spark.readStream.schema(schema)
    if max_files_per_batch:
        stream = stream.option("maxFilesPerTrigger", max_files_per_batch)
    folder = f"{side or path.rstrip('/') + '-broken'}/load={md5(checkpoint.encode()).hexdigest()[:12]}"

    def merge_batch(batch: DataFrame, epoch: int) -> None:
        checked = materialize(rules.broken(batch), "checked_batch")
        checked.filter(F.size(BROKEN) > 0).write.mode("overwrite").parquet(f"{folder}/batch={epoch}")
        good = checked.filter(F.size(BROKEN) == 0).drop(BROKEN)
        one = materialize(dedupe_by_key(good, rules.keys, order).withColumn(PART, part), "partitioned_batch")
        stored = touched_part(read_partitioned(spark, path, schema), one)
        new = materialize(keys_absent(one, stored.drop(PART), rules.keys).select(*schema.names, PART), "new_rows")
        append_folders(new, path)  # cutting ranges reads the rows twice

    query = (stream.parquet(landing_dir).writeStream.foreachBatch(merge_batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return read_partitioned(spark, path, schema).drop(PART)


def broken_rows(spark: SparkSession, path: str, schema: T.StructType, side: str | None = None) -> DataFrame:
    """Every row that loads of the table at ``path`` set aside, with its rules."""
    full = T.StructType([*schema.fields, T.StructField(BROKEN, T.ArrayType(T.StringType()))])
    return (spark.read.schema(full).option("recursiveFileLookup", "true")
            .parquet(side or path.rstrip("/") + "-broken"))
