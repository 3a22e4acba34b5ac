"""Writing tables: insert-select with column alignment, create-or-replace as
a new snapshot folder, literal rows.

A table folder is never overwritten while a plan still reads it (Spark refuses
that, and a failed overwrite would lose the data): ``overwrite`` writes a new
snapshot folder and returns the table read from it.
"""

from __future__ import annotations

import uuid
from typing import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.session import scratch_path


def align(df: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """Insert-select alignment: columns matched by name and cast to the
    table's types; columns the insert leaves out get their default or NULL
    (a column-list insert)."""
    defaults = defaults or {}
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def positional(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``insert into t select *``: columns matched by position."""
    if len(df.columns) != len(schema.fields):
        raise ValueError("positional insert needs the same number of columns")
    return df.select(*[F.col(c).cast(f.dataType).alias(f.name) for c, f in zip(df.columns, schema.fields)])


def append(df: DataFrame, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Append rows to the Parquet table at ``path`` (new files only; readers of
    the old files are unaffected).  Returns the table."""
    spark = df.sparkSession
    out = align(df, schema) if schema is not None else df
    out.write.mode("append").parquet(path)
    return spark.read.parquet(path)


def overwrite(df: DataFrame, name: str) -> DataFrame:
    """Create-or-replace: the new content goes to a fresh snapshot folder."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def literal_rows(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType | str) -> DataFrame:
    """A literal row source (``select <values>`` / ``insert ... values``)."""
    return spark.createDataFrame(list(rows), schema)


class NamedTable:
    """A name that follows its newest snapshot: ``create or replace table``.

    Below ``path`` every replacement is a folder of its own, and one row in
    ``current`` per replacement names it.  The row is written after the folder,
    so a reader sees the whole old content or the whole new one; what it has
    opened stays readable, as no folder is overwritten.  One writer at a time."""

    POINTERS = "version long, folder string"

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def versions(self) -> DataFrame:
        """(version, folder) of every replacement so far."""
        try:
            return self.spark.read.schema(self.POINTERS).parquet(f"{self.path}/current")
        except AnalysisException:  # never created
            return self.spark.createDataFrame([], self.POINTERS)

    def replace(self, df: DataFrame) -> DataFrame:
        """The table's new content (columns matched by name, cast to its types)."""
        last = self.versions().agg(F.max("version")).first()[0] or 0
        folder = f"{self.path}/v{last + 1:08d}-{uuid.uuid4().hex[:8]}"
        align(df, self.schema).write.parquet(folder)
        self.spark.createDataFrame([(last + 1, folder)], self.POINTERS).coalesce(1).write.mode("append").parquet(
            f"{self.path}/current")
        return self.read()

    def read(self, version: int | None = None) -> DataFrame:
        """The newest content, or that of an earlier ``version``."""
        rows = self.versions() if version is None else self.versions().filter(F.col("version") == version)
        top = rows.orderBy(F.desc("version")).first()
        if top is None:
            raise ValueError("the table was never created" if version is None else f"no version {version}")
        return self.spark.read.schema(self.schema).parquet(top.folder)
