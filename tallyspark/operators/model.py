"""Dimensional modelling: look-up levels with surrogate keys, parent-key
resolution with unmatched output, hierarchy flattening, calendar dimension.

Level tables (distinct names of a hierarchy level) are small relative to the
facts, but their size is still data-dependent, so joins against them carry no
broadcast hint: Spark's size-checked auto-broadcast / AQE decides.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.ordered import assign_keys
from tallyspark.operators.sizing import lookup_join


def build_level(src: DataFrame, name_cols: Sequence[str], key: str,
                parent: tuple[DataFrame, Sequence[str], str] | None = None) -> DataFrame:
    """A look-up level: distinct ``name_cols`` of ``src`` (+ the parent key
    resolved by the parent's name columns), numbered 1.. in natural-key order
    so that a re-run gives the same keys.

    ``parent`` = (parent_level, columns of src naming the parent, parent key).
    Names may repeat under different parents (brand X in two categories): the
    level keeps one row per (name, parent)."""
    if parent is None:
        distinct = src.select(*name_cols).distinct()
        return assign_keys(distinct, list(name_cols), key).select(key, *name_cols)
    plevel, pnames, pkey = parent
    distinct = src.select(*name_cols, *pnames).distinct()
    resolved = distinct.join(plevel.select(pkey, *pnames), list(pnames), "inner").select(*name_cols, pkey)
    return assign_keys(resolved, list(name_cols) + [pkey], key).select(key, *name_cols, pkey)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` guarded against fan-out: whatever reads it fails if its ``keys``
    are not unique.  Part of the plan (one grouping of the look-up), so it
    costs no job of its own."""
    rest = [c for c in df.columns if c not in keys]
    one = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in rest])
    failed = F.raise_error(F.lit(f"look-up key {list(keys)} is not unique")).cast("boolean")
    return one.filter(F.when(F.col("_n") == 1, F.lit(True)).otherwise(failed)).select(*df.columns)


def resolve_parent(src: DataFrame, level: DataFrame, on: Sequence[str],
                   level_key: str) -> tuple[DataFrame, DataFrame]:
    """Replace the naming columns ``on`` of ``src`` by the level's key.
    Returns (matched, unmatched): an inner look-up silently loses rows whose
    name the level lacks -- they are handed out instead of dropped.  A name
    that the level holds twice fails (``assert_unique``)."""
    lv = assert_unique(level.select(level_key, *on), on)
    matched = src.join(lv, list(on), "inner").drop(*on)
    unmatched = src.join(level.select(*on), list(on), "left_anti").select(*src.columns)
    return matched, unmatched


def flatten_hierarchy(child: DataFrame, parents: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Join a child level to its chain of parents once (child -> parent ->
    grand-parent ...), giving a flat look-up to join facts against in one hop.
    ``parents`` = [(parent_df, child_fk, parent_pk), ...] applied in order."""
    cur = child
    for parent, fk, pk in parents:
        if fk == pk:
            cur = cur.join(parent, fk, "inner")
        else:
            cur = cur.join(parent, cur[fk] == parent[pk], "inner").drop(parent[pk])
    return cur


def calendar(dates: DataFrame, date_col: str) -> DataFrame:
    """Calendar dimension covering the range of ``date_col`` in ``dates``:
    date_key yyyymmdd, day, day name, ISO week, month number and name, quarter
    label, year and weekend flag.  The range comes from a one-row min/max
    aggregate; the day rows come from ``sequence`` + ``explode`` -- one row per
    calendar day, bounded by the date range, not by the number of facts."""
    bounds = dates.agg(F.min(F.to_date(date_col)).alias("lo"), F.max(F.to_date(date_col)).alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    d = F.col("date")
    return days.select(
        (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int").alias("date_key"),
        d.alias("date"),
        F.dayofmonth(d).cast("int").alias("day"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).cast("int").alias("week_no"),
        F.month(d).cast("int").alias("month_no"),
        F.date_format(d, "MMMM").alias("month"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter"),
        F.year(d).cast("int").alias("year"),
        F.when(F.dayofweek(d).isin(1, 7), F.lit("Yes")).otherwise(F.lit("No")).alias("is_weekend"),
    )


def load_dimension(src: DataFrame, natural: Sequence[str], attributes: Sequence[str], key: str) -> DataFrame:
    """A dimension with its own dense key, numbered in ``natural`` key order
    (which must be unique in ``src``)."""
    return assign_keys(src.select(*natural, *attributes), list(natural), key).select(key, *natural, *attributes)


def load_fact(src: DataFrame, lookups: Sequence[tuple[DataFrame, Sequence[str], str]],
              measures: Sequence[Column], fact_key: str | None = None,
              order: Sequence[str] = ()) -> DataFrame:
    """Fact load: swap natural keys for surrogate keys.
    ``lookups`` = [(dimension, natural key columns shared with src, surrogate key)];
    other columns of a dimension come along for ``measures``.  Each dimension
    is guarded against fan-out and broadcast only when proven small
    (``lookup_join``), otherwise joined by sort-merge -- the fact itself is
    never broadcast.  ``fact_key`` numbers the rows in ``order`` (unique)."""
    cur = src
    for dim, nat, sk in lookups:
        cur = lookup_join(cur, assert_unique(dim, nat), list(nat), "inner")
    out = cur.select(*[sk for _, _, sk in lookups], *measures)
    return out if fact_key is None else assign_keys(out, list(order), fact_key).select(fact_key, *out.columns)


def fact_unmatched(src: DataFrame, lookups: Sequence[tuple[DataFrame, Sequence[str], str]]) -> DataFrame:
    """The rows of ``src`` that ``load_fact`` cannot resolve, with the first
    look-up that lacks them in ``missing`` (its surrogate key's name)."""
    cur = src.withColumn("missing", F.lit(None).cast("string"))
    for dim, nat, sk in lookups:
        keys = assert_unique(dim.select(sk, *nat), nat).withColumnRenamed(sk, "_found")
        cur = lookup_join(cur, keys, list(nat), "left").withColumn(
            "missing", F.coalesce("missing", F.when(F.col("_found").isNull(), F.lit(sk)))).drop("_found")
    return cur.filter(F.col("missing").isNotNull()).select(*src.columns, "missing")
