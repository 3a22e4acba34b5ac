"""Table changes as pure DataFrame jobs: (old table, input) -> new table.

Parquet has no UPDATE/DELETE/MERGE/time travel, so each statement is a
function returning the new state; callers write it to a *new* snapshot folder
(``sources.sinks.overwrite``) -- a path is never overwritten while read.
All functions are deterministic and idempotent where the statement is
(running ``merge_insert_only`` twice changes nothing), which is what an
at-least-once ``foreachBatch`` needs.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.columns import any_changed
from tallyspark.operators.sizing import BROADCAST_BYTES, broadcast_if_small
from tallyspark.operators.views import materialize


def dedupe_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first by ``order`` (then by all other columns, so
    the pick is deterministic).  Written as ``min(struct(...))`` per key -- a
    plain aggregate with map-side partial aggregation, so a hot key is reduced
    inside each task before the shuffle instead of landing whole in one."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in list(order) + rest]).alias("_r")
    picked = df.groupBy(*keys).agg(F.min(packed).alias("_r"))
    return picked.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in list(order) + rest]).select(*df.columns)


def keys_absent(rows: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` whose key ``table`` lacks.  When the key set of ``rows`` is
    proven small, the table's key columns are streamed past it (broadcast
    semi-join, no shuffle of the table) to find the keys already present, and
    the anti-join runs on batch-sized frames; otherwise a plain anti-join."""
    row_keys, small = broadcast_if_small(rows.select(*keys).distinct())
    if small:
        present = table.select(*keys).join(row_keys, list(keys), "left_semi")
        return rows.join(present, list(keys), "left_anti")
    return rows.join(table.select(*keys), list(keys), "left_anti")


def rows_to_insert(target: DataFrame, source: DataFrame, keys: Sequence[str],
                   order: Sequence[str] = ()) -> DataFrame:
    """The source rows an insert-only merge adds: one per key (duplicates
    reduced), only keys the target lacks.  Only the target's key columns are
    read.  The reduced batch is stored once: its size check and its key set are
    read from there, not derived from the source again."""
    src = materialize(dedupe_by_key(source.select(*target.columns), keys, order), "merge_source")
    return keys_absent(src, target, keys)


def merge_insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str],
                      order: Sequence[str] = ()) -> DataFrame:
    """``merge into t using s on key when not matched then insert``.
    Matched target rows are untouched; source duplicates are reduced first."""
    return target.unionByName(rows_to_insert(target, source, keys, order))


def update_from(target: DataFrame, source: DataFrame, keys: Sequence[str],
                set_exprs: Mapping[str, Column], condition: Column | None = None,
                order: Sequence[str] = ()) -> DataFrame:
    """``update t set c = expr from s where t.key = s.key [and condition]``.

    Expressions refer to ``t.<col>`` (old target value) and ``u.<col>``
    (source); every SET reads the *old* row.  Target rows without a source row
    are kept; the source is reduced to one row per key first (a warehouse
    would pick an arbitrary one)."""
    # stored once: neither the size check nor the join computes the source again
    src, _ = broadcast_if_small(materialize(dedupe_by_key(source, keys, order), "update_source"),
                                max_bytes=BROADCAST_BYTES)
    src = src.alias("u")
    t = target.alias("t")
    cond = None
    for k in keys:
        c = F.col(f"t.{k}") == F.col(f"u.{k}")
        cond = c if cond is None else cond & c
    j = t.join(src, cond, "left")
    matched = F.col(f"u.{keys[0]}").isNotNull()
    if condition is not None:
        matched = matched & F.coalesce(condition, F.lit(False))
    out = []
    for c in target.columns:
        if c in set_exprs:
            out.append(F.when(matched, set_exprs[c]).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.col(f"t.{c}").alias(c))
    return j.select(*out)


def update_where(df: DataFrame, predicate: Column, set_exprs: Mapping[str, Column]) -> DataFrame:
    """``update t set c = expr where predicate``; all SETs read the old row."""
    hit = F.coalesce(predicate, F.lit(False))
    return df.select(*[F.when(hit, set_exprs[c]).otherwise(F.col(c)).alias(c) if c in set_exprs
                       else F.col(c) for c in df.columns])


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """``delete from t where predicate`` (rows where it is NULL stay)."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def restore_rows(current: DataFrame, snapshot: DataFrame, predicate: Column,
                 keys: Sequence[str]) -> DataFrame:
    """Re-insert the rows matching ``predicate`` from an earlier snapshot,
    unless their key is present again (safe to run twice)."""
    back = keys_absent(snapshot.filter(predicate), current, keys)
    return current.unionByName(back.select(*current.columns))


def clone_table(df: DataFrame, name: str) -> DataFrame:
    """An independent copy: written once to its own folder; changes to the
    copy never touch the original."""
    return materialize(df, name)


def diverged(original: DataFrame, clone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the clone whose key the original lacks."""
    return clone.join(original.select(*keys), list(keys), "left_anti")


ACTION = "_action"
IS_UPDATE = "_is_update"


def change_feed(before: DataFrame, after: DataFrame, keys: Sequence[str],
                compare: Sequence[str] | None = None) -> DataFrame:
    """Net changes between two snapshots, as a table stream would report them:
    key only after -> INSERT/false; only before -> DELETE/false; in both with a
    (null-safe) difference -> DELETE/true with old values and INSERT/true with
    new values; unchanged -> nothing.  One full outer join; the 0-2 output rows
    of each key come from one ``inline`` of a filtered struct array."""
    cols = before.columns
    compare = [c for c in (compare or cols) if c not in keys]
    b = before.withColumn("_in_b", F.lit(True)).alias("b")
    a = after.select(*cols).withColumn("_in_a", F.lit(True)).alias("a")
    cond = None
    for k in keys:
        c = F.col(f"b.{k}") == F.col(f"a.{k}")
        cond = c if cond is None else cond & c
    j = b.join(a, cond, "full_outer")
    in_b = F.col("b._in_b").isNotNull()
    in_a = F.col("a._in_a").isNotNull()
    changed = in_b & in_a & any_changed([(F.col(f"b.{c}"), F.col(f"a.{c}")) for c in compare])

    def side(p: str, action: str, upd: Column) -> Column:
        return F.struct(*[F.col(f"{p}.{c}").alias(c) for c in cols],
                        F.lit(action).alias(ACTION), upd.alias(IS_UPDATE))

    old_row = F.when((in_b & ~in_a) | changed, side("b", "DELETE", changed))
    new_row = F.when((in_a & ~in_b) | changed, side("a", "INSERT", changed))
    rows = F.filter(F.array(old_row, new_row), lambda x: x.isNotNull())
    return j.select(F.inline(rows))


def new_rows(feed: DataFrame) -> DataFrame:
    """Rows newly inserted (not the insert half of an update)."""
    return feed.filter((F.col(ACTION) == "INSERT") & ~F.col(IS_UPDATE)).drop(ACTION, IS_UPDATE)
