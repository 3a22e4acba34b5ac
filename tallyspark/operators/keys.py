"""Surrogate keys that stay from load to load.

A registry is a stored table (natural key -> surrogate key) that only grows:
each load adds the natural keys it does not hold yet, numbered from its largest
key on, and every other key keeps its number, so facts loaded before still point
at the right row.  Natural keys are compared null-safely: a NULL name is a
member of its own.

Scale: a load reduces its source to distinct natural keys (combined before the
shuffle) and anti-joins them with the registry, broadcasting the load's keys
when they are proven few, so a large registry is streamed past them and never
shuffled; only the keys that are really new are put in order and numbered.  A
load appends its new rows as files of their own, named after the load: a replay
finds them present and adds nothing.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.operators.ordered import continue_keys
from tallyspark.operators.sizing import broadcast_if_small, lookup_join
from tallyspark.operators.views import materialize

LOAD = "_load"


def same_keys(left: Sequence[Column], right: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) for x, y in zip(left, right, strict=True)])


def keys_to_add(registry: DataFrame, source: DataFrame, natural: Sequence[str], key: str) -> DataFrame:
    """(key, natural): the natural keys of ``source`` that ``registry`` lacks,
    numbered on from its largest key in natural order."""
    names = materialize(source.select(*natural).distinct(), "registry_source")
    wanted, few = broadcast_if_small(names.select(*[F.col(c).alias(f"_n_{c}") for c in natural]))
    known = registry.select(*natural)
    if few:  # stream the registry past the load's keys
        on = same_keys([F.col(c) for c in natural], [F.col(f"_n_{c}") for c in natural])
        known = known.join(wanted, on, "left_semi")
    held = known.select(*[F.col(c).alias(f"_h_{c}") for c in natural])
    on = same_keys([F.col(c) for c in natural], [F.col(f"_h_{c}") for c in natural])
    new = names.join(held, on, "left_anti")
    return continue_keys(registry, new, list(natural), key).select(key, *natural)


class KeyRegistry:
    """The stored registry below ``path``: (key, natural), one folder a load."""

    def __init__(self, spark: SparkSession, path: str, key: str, natural: T.StructType):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.natural = natural.names
        self.schema = T.StructType([T.StructField(key, T.LongType()), *natural.fields,
                                    T.StructField(LOAD, T.StringType())])

    def rows(self, with_load: bool = False) -> DataFrame:
        """All keys given out so far (``with_load``: and the load that did)."""
        try:
            held = self.spark.read.schema(self.schema).option("basePath", self.path).parquet(self.path)
        except AnalysisException:  # no load yet
            held = self.spark.createDataFrame([], self.schema)
        return held.select(self.key, *self.natural, *([LOAD] if with_load else []))

    def load(self, source: DataFrame, load_id: str) -> DataFrame:
        """Adds the new natural keys of ``source`` under ``load_id`` and gives
        all keys.  One load at a time; a load that was cut off is run again."""
        new = keys_to_add(self.rows(), source, self.natural, self.key)
        new.write.mode("append").parquet(f"{self.path}/{LOAD}={load_id}")
        return self.rows()

    def resolve(self, df: DataFrame) -> DataFrame:
        """``df`` with its natural key columns replaced by the surrogate key
        (NULL for a natural key that no load has registered)."""
        side = self.rows().select(self.key, *[F.col(c).alias(f"_r_{c}") for c in self.natural])
        on = same_keys([F.col(c) for c in self.natural], [F.col(f"_r_{c}") for c in self.natural])
        rest = [c for c in df.columns if c not in self.natural]
        return lookup_join(df, side, on, "left").select(self.key, *rest)


def load_levels(registries: Sequence[KeyRegistry], source: DataFrame, load_id: str) -> None:
    """Loads a hierarchy top down from the name columns of ``source``.  The
    natural key of a level is its name and its parent's surrogate key; each
    level's registry resolves the names below it."""
    paths = materialize(source.select(*[r.natural[0] for r in registries]).distinct(), "hierarchy_paths")
    for registry in registries:
        registry.load(paths, load_id)
        paths = materialize(registry.resolve(paths), "hierarchy_resolved")
