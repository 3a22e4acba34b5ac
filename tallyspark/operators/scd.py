"""Slowly changing dimensions as pure DataFrame jobs.

A versioned dimension row carries ``effective_date``, ``expiry_date`` (open
end 9999-12-31) and ``is_current``.  Every ``*_apply`` takes the dimension and
a batch of updates (key, attributes, optionally ``effective_date``) and returns
the new dimension; history rows pass through untouched.

Scale: a batch touches few keys of a large dimension.  The dimension is split
once into the versions of keys named in the batch and all other rows
(``split_by_keys``: broadcast semi/anti joins when the batch's key set is
proven small, so the dimension is streamed, not shuffled); the versioning
joins and windows run on the touched part only and the untouched rows are
unioned back unchanged.  Chaining several updates of one key inside one batch
uses ``with_neighbors`` (a window for small batches, sequence-number joins for
large ones, so a key with very many updates does not land in one task).
"""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.columns import OPEN_END, any_changed, day_before, differs
from tallyspark.operators.changes import dedupe_by_key, update_from
from tallyspark.operators.ordered import SMALL_ROWS, carry_forward, continue_keys, with_neighbors
from tallyspark.operators.sizing import BROADCAST_BYTES, BROADCAST_ROWS, broadcast_if_small, proven_small, split_by_keys
from tallyspark.operators.views import materialize

EFF, EXP, CUR = "effective_date", "expiry_date", "is_current"


def _lit_date(d: dt.date | str | Column) -> Column:
    if isinstance(d, Column):
        return d
    return F.lit(d if isinstance(d, dt.date) else dt.date.fromisoformat(d))


# ---------------------------------------------------------------- diffs
def changed_rows(dim: DataFrame, upd: DataFrame, key: str, tracked: Sequence[str],
                 null_safe: bool = True) -> DataFrame:
    """Keys whose tracked attributes changed: key, old_<a>, new_<a>."""
    j = dim.alias("d").join(upd.alias("u"), key)
    pairs = [(F.col(f"d.{a}"), F.col(f"u.{a}")) for a in tracked]
    cols = [F.col(key)]
    for a in tracked:
        cols += [F.col(f"d.{a}").alias(f"old_{a}"), F.col(f"u.{a}").alias(f"new_{a}")]
    return j.filter(any_changed(pairs, null_safe)).select(*cols)


def attribute_changes(dim: DataFrame, upd: DataFrame, key: str, tracked: Sequence[str],
                      null_safe: bool = True) -> DataFrame:
    """Attribute-level diff in long form (key, attribute, old_value, new_value):
    one join, then the tracked pairs are unpivoted with ``inline`` and the
    unchanged ones dropped (instead of one join per attribute + UNION ALL)."""
    j = dim.alias("d").join(upd.alias("u"), key)
    pairs = F.array(*[F.struct(F.lit(a).alias("attribute"),
                               F.col(f"d.{a}").cast("string").alias("old_value"),
                               F.col(f"u.{a}").cast("string").alias("new_value"))
                      for a in tracked])
    long = j.select(F.col(key), F.inline(pairs))
    return long.filter(differs(F.col("old_value"), F.col("new_value"), null_safe))


# ---------------------------------------------------------------- type 1
def _latest(upd: DataFrame, key: str) -> DataFrame:
    """One update per key: that of the latest effective date, and of several on
    that day the one with the smallest other columns (a fixed choice)."""
    rest = [c for c in upd.columns if c not in (key, EFF)]
    if EFF not in upd.columns:
        return upd
    newest = F.struct(F.col(EFF), *[F.col(c) for c in rest]).alias("_r")
    top = upd.groupBy(key).agg(F.max(EFF).alias("_top"))
    j = upd.join(top, key).filter(F.col(EFF).eqNullSafe(F.col("_top")))
    return j.groupBy(key).agg(F.min(newest).alias("_r")).select(
        key, *[F.col(f"_r.{c}").alias(c) for c in [EFF, *rest]]).select(*upd.columns)


def _one_per_day(upd: DataFrame, key: str) -> DataFrame:
    """One update per key and effective date (the smallest other columns), so
    that no version can end before it starts."""
    return dedupe_by_key(upd, [key, EFF])


def scd1_apply(dim: DataFrame, upd: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Type 1: overwrite the attributes in place (history is lost); of several
    updates of a key the latest one wins."""
    upd = _latest(upd, key)
    return update_from(dim, upd, [key], {c: F.col(f"u.{c}") for c in cols})


# ---------------------------------------------------------------- type 2
def scd2_init(df: DataFrame, start: dt.date | str, end: dt.date = OPEN_END) -> DataFrame:
    """Initial load: every row current from ``start`` to the open end."""
    return df.select(*df.columns, _lit_date(start).alias(EFF), _lit_date(end).alias(EXP),
                     F.lit(True).alias(CUR))


def _chain(cur: DataFrame, upd: DataFrame, key: str, tracked: Sequence[str],
           carry: Sequence[str], small: bool | None = None) -> DataFrame:
    """Updates that really change something, each with the values of the
    version it replaces (``prev_<c>`` for ``carry`` columns) and its expiry.

    The predecessor of the first update of a key is the current row; of a later
    one the previous update of the batch.  Updates equal to their predecessor,
    or not later than the current version, are dropped (idempotent under
    re-delivery); expiry = next kept update - 1.  Neighbours within a key come
    from ``with_neighbors``: a window for small batches, skew-proof
    sequence-number joins for large ones (a key with very many updates is not
    handled by one task).
    """
    cur_s = cur.select(F.col(key), F.lit(True).alias("_known"), F.col(EFF).alias("_c_eff"),
                       *[F.col(c).alias(f"_c_{c}") for c in carry])
    cur_s, _ = broadcast_if_small(cur_s, SMALL_ROWS, small, BROADCAST_BYTES)  # whole rows
    # an update effective on/before the current version's start is already in
    # the table (a replayed batch) -- skip it, so re-applying changes nothing
    u = _one_per_day(upd, key).select(*upd.columns).join(cur_s, key, "left").filter(F.col("_c_eff").isNull() | (F.col(EFF) > F.col("_c_eff")))
    in_upd = [c for c in carry if c in upd.columns]
    u = with_neighbors(u, [key], [EFF], prev_cols=in_upd, known_small=small)
    prev = {c: F.when(F.col("_has_prev"), F.col(f"prev_{c}")).otherwise(F.col(f"_c_{c}"))
            if c in upd.columns else F.col(f"_c_{c}") for c in carry}
    u = u.select(*upd.columns, F.coalesce(F.col("_known"), F.lit(False)).alias("_known"),
                 (~F.col("_has_prev")).alias("_first"),
                 *[prev[c].alias(f"prev_{c}") for c in carry])
    is_new_key = ~F.col("_known") & F.col("_first")
    changed = any_changed([(F.col(a), F.col(f"prev_{a}")) for a in tracked])
    kept = u.filter(is_new_key | changed).drop("_known", "_first")
    kept = with_neighbors(kept, [key], [EFF], next_cols=[EFF], known_small=small)
    kept = kept.select(*[c for c in kept.columns if c not in (f"next_{EFF}", "_has_prev", "_has_next")],
                       F.coalesce(day_before(F.col(f"next_{EFF}")), F.lit(OPEN_END)).alias(EXP),
                       (~F.col("_has_next")).alias(CUR))
    # batch-sized; expiring, inserting and synchronising all read it
    return materialize(kept, "scd_kept")


def late_updates(dim: DataFrame, upd: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """The updates that an apply passes over although ``dim`` does not hold
    them: dated on or before their key's current version, and different from
    the version valid on that day (or older than the first one).  A replayed
    batch has none.  They are handed out for a correction of the history."""
    touched, _ = _split(dim, upd, key)
    now = touched.filter(F.col(CUR)).select(key, F.col(EFF).alias("_c_eff"))
    old = _one_per_day(upd, key).select(*upd.columns).join(now, key).filter(F.col(EFF) <= F.col("_c_eff")).alias("u")
    then = touched.select(F.col(key).alias("_k"), F.col(EFF).alias("_from"), F.col(EXP).alias("_to"),
                          *[F.col(a).alias(f"_then_{a}") for a in tracked])
    j = old.join(then, (F.col(f"u.{key}") == F.col("_k")) & F.col(f"u.{EFF}").between(F.col("_from"), F.col("_to")),
                 "left")
    news = F.col("_k").isNull() | any_changed([(F.col(f"u.{a}"), F.col(f"_then_{a}")) for a in tracked])
    return j.filter(news).select(*[F.col(f"u.{c}") for c in upd.columns])


def splice_late(dim: DataFrame, upd: DataFrame, key: str, tracked: Sequence[str],
                version_key: str | None = None) -> DataFrame:
    """Type 2 history with late updates put where they belong.  An update dated
    on or before its key's current version cuts the version valid on that day in
    two: the older part ends the day before, the new one lasts to the next
    version's start.  One dated on a version's own first day corrects that
    version; one older than the first becomes the first.  Columns that ``upd``
    lacks come from the version that was cut (or the first one).

    An update that equals what is valid before it changes nothing, so a replay
    does not.  Later updates and unknown keys are left to ``scd2_apply`` (run it
    afterwards; ``scd2_apply(late='splice')`` does).  Expects histories without
    gaps, as the functions here build them.  New versions get ``version_key``
    numbers from the largest one on.

    The rest of the dimension is streamed past the batch's keys; the versions
    of those keys find their neighbours by ``with_neighbors`` and the version
    that is cut by ``carry_forward``, neither of which puts a key into one
    task."""
    small = _small_batch(upd)
    one = _one_per_day(upd, key)
    touched, untouched = _split(dim, upd, key, small)
    touched = materialize(touched, "scd_touched")
    now = touched.filter(F.col(CUR)).select(key, F.col(EFF).alias("_c_eff"))
    late = one.join(now, key).filter(F.col(EFF) <= F.col("_c_eff")).select(*one.columns)
    late = materialize(late, "scd_late")
    attrs = [c for c in dim.columns if c not in (key, EFF, EXP, CUR, version_key)]
    given, kept = [c for c in attrs if c in upd.columns], [c for c in attrs if c not in upd.columns]

    # corrections of a version on its own first day
    fixes = late.select(key, EFF, F.struct(*[F.col(c) for c in given]).alias("_fix"))
    fixed = touched.join(fixes, [key, EFF], "left").select(
        *[F.when(F.col("_fix").isNotNull(), F.col(f"_fix.{c}")).otherwise(F.col(c)).alias(c) if c in given else F.col(c)
          for c in dim.columns], F.lit(False).alias("_new"))
    added = late.join(touched.select(key, EFF), [key, EFF], "left_anti")
    rows = fixed.unionByName(added.select(*[c for c in dim.columns if c in (key, EFF, *given)],
                                          F.lit(True).alias("_new")), allowMissingColumns=True)
    if kept:
        rows = carry_forward(rows.withColumn("_from", F.when(~F.col("_new"), F.struct(*[F.col(c) for c in kept]))),
                             [key], [EFF], "_from", "_cut")
        first = touched.groupBy(key).agg(F.min_by(F.struct(*[F.col(c) for c in kept]), EFF).alias("_first"))
        rows = rows.join(first, key)
        for c in kept:
            rows = rows.withColumn(c, F.when(F.col("_new"), F.coalesce("_cut", "_first")[c]).otherwise(F.col(c)))
        rows = rows.drop("_from", "_cut", "_first")
    rows = with_neighbors(rows, [key], [EFF], prev_cols=list(tracked))
    same = F.col("_has_prev") & ~any_changed([(F.col(a), F.col(f"prev_{a}")) for a in tracked])
    rows = rows.filter(~(F.col("_new") & same)).select(*dim.columns, "_new")
    rows = with_neighbors(rows, [key], [EFF], next_cols=[EFF])
    end = F.when(F.col("_has_next"), day_before(F.col(f"next_{EFF}"))).otherwise(F.coalesce(EXP, F.lit(OPEN_END)))
    rows = materialize(rows.select(*[c for c in dim.columns if c not in (EXP, CUR)], end.alias(EXP),
                                   (~F.col("_has_next") & F.coalesce(F.col(CUR), F.lit(True))).alias(CUR), "_new"),
                       "scd_spliced")
    new = rows.filter("_new").select(*[c for c in dim.columns if c != version_key])
    if version_key:
        new = continue_keys(dim, new, [key, EFF], version_key)
    return (untouched.unionByName(rows.filter("NOT _new").select(*dim.columns))
            .unionByName(new.select(*dim.columns)))


def _split(dim: DataFrame, upd: DataFrame, key: str, small: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of ``dim`` of the keys in ``upd``, and the others.  An apply
    splits several times, and every broadcast key set passes the driver, so only
    a set of ``SMALL_ROWS`` keys is broadcast; a larger one is joined by shuffle."""
    return split_by_keys(dim, upd, [key], SMALL_ROWS, small or None)


def _small_batch(upd: DataFrame) -> bool:
    """One size check per apply: every frame derived from the batch (its keys,
    the touched current rows, the chain) is bounded by the batch's row count."""
    return proven_small(upd, min(SMALL_ROWS, BROADCAST_ROWS))


def _expire(dim: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """Close the current version of every key with a kept update:
    expiry = first kept effective date - 1, is_current = false."""
    first = kept.groupBy(key).agg(F.min(EFF).alias("_first_eff"))
    d = dim.join(first, key, "left")
    hit = F.col(CUR) & F.col("_first_eff").isNotNull()
    return d.select(*[F.when(hit, day_before(F.col("_first_eff"))).otherwise(F.col(EXP)).alias(EXP) if c == EXP
                      else F.when(hit, F.lit(False)).otherwise(F.col(CUR)).alias(CUR) if c == CUR
                      else F.col(c) for c in dim.columns])


def scd2_apply(dim: DataFrame, upd: DataFrame, key: str, tracked: Sequence[str],
               version_key: str | None = None, late: str = "hand out") -> DataFrame:
    """Type 2: a changed key gets its current row closed (expiry = effective-1)
    and a new open, current row; unchanged updates do nothing; unknown keys
    get a first row.  One current row per key; intervals do not overlap.
    New versions get ``version_key`` numbers from the largest one of ``dim``
    on, by key and date; columns that ``upd`` lacks come from the version that
    is replaced.  Late updates are left to ``late_updates``, or with
    ``late='splice'`` put into the history first (``splice_late``)."""
    if late not in ("hand out", "splice"):
        raise ValueError(late)
    if late == "splice":
        dim = materialize(splice_late(dim, upd, key, tracked, version_key), "scd_history")
    small = _small_batch(upd)
    touched, untouched = _split(dim, upd, key, small)
    cur = touched.filter(F.col(CUR))
    attrs = [c for c in dim.columns if c not in (EFF, EXP, CUR, version_key)]
    kept = _chain(cur, upd, key, tracked, [c for c in attrs if c != key], small or None)
    new_rows = kept.select(*[F.col(c) if c in kept.columns else F.col(f"prev_{c}").alias(c)
                             for c in dim.columns if c != version_key])
    if version_key:
        new_rows = continue_keys(dim, new_rows, [key, EFF], version_key)
    return untouched.unionByName(_expire(touched, kept, key)).unionByName(new_rows)


# ---------------------------------------------------------------- type 3
def scd3_apply(dim: DataFrame, upd: DataFrame, key: str, source_col: str,
               current_col: str, previous_col: str, also_set: Sequence[str] = ()) -> DataFrame:
    """Type 3: when the tracked value differs, previous <- old current,
    current <- new, plus ``also_set`` columns; otherwise the row is unchanged
    (a change of the other attributes alone is not applied)."""
    upd = _latest(upd, key)
    sets = {previous_col: F.col(f"t.{current_col}"), current_col: F.col(f"u.{source_col}")}
    sets.update({c: F.col(f"u.{c}") for c in also_set})
    cond = differs(F.col(f"t.{current_col}"), F.col(f"u.{source_col}"), null_safe=False)
    return update_from(dim, upd, [key], sets, condition=cond)


def scd3_init(df: DataFrame, source_col: str, current_col: str, previous_col: str) -> DataFrame:
    return df.select(*[F.col(c).alias(current_col) if c == source_col else F.col(c) for c in df.columns],
                     F.lit(None).cast("string").alias(previous_col))


# ---------------------------------------------------------------- type 6
def scd6_init(df: DataFrame, source_col: str, start: dt.date | str,
              cur_c: str = "current_membership", prev_c: str = "previous_membership",
              hist_c: str = "historical_membership") -> DataFrame:
    base = df.select(*[c for c in df.columns if c != source_col],
                     F.col(source_col).alias(cur_c), F.lit(None).cast("string").alias(prev_c),
                     F.col(source_col).alias(hist_c))
    return scd2_init(base, start)


def scd6_apply(dim: DataFrame, upd: DataFrame, key: str, tracked: Sequence[str], source_col: str,
               cur_c: str = "current_membership", prev_c: str = "previous_membership",
               hist_c: str = "historical_membership") -> DataFrame:
    """Type 6 (1+2+3): as type 2; the new row carries current = new value,
    previous = the replaced version's current value, historical = new value.
    Older rows are not re-synchronised."""
    u = upd.withColumnRenamed(source_col, cur_c)
    tracked6 = [cur_c if a == source_col else a for a in tracked]
    small = _small_batch(upd)
    touched, untouched = _split(dim, upd, key, small)
    cur = touched.filter(F.col(CUR))
    attrs = [c for c in dim.columns if c not in (EFF, EXP, CUR, prev_c, hist_c)]
    kept = _chain(cur, u, key, tracked6, [c for c in attrs if c != key], small or None)
    new_rows = kept.select(*[F.col(f"prev_{cur_c}").alias(prev_c) if c == prev_c
                             else F.col(cur_c).alias(hist_c) if c == hist_c
                             else F.col(c) for c in dim.columns])
    return untouched.unionByName(_expire(touched, kept, key)).unionByName(new_rows)


# ---------------------------------------------------------------- hybrid
def hybrid_init(df: DataFrame, source_col: str, start: dt.date | str, city_col: str = "city",
                prev_city: str = "previous_city") -> DataFrame:
    base = scd6_init(df, source_col, start)
    return base.select(*[c for c in base.columns if c not in (EFF, EXP, CUR)],
                       F.lit(None).cast("string").alias(prev_city), EFF, EXP, CUR)


def scd_hybrid_apply(dim: DataFrame, upd: DataFrame, key: str, tracked: Sequence[str],
                     source_col: str, sync: Sequence[str], city_col: str = "city",
                     prev_city: str = "previous_city", cur_c: str = "current_membership",
                     prev_c: str = "previous_membership", hist_c: str = "historical_membership",
                     first: DataFrame | None = None) -> DataFrame:
    """Hybrid: type 2 rows (new row: current = new, previous = replaced
    version's current, previous_city = replaced version's city, historical =
    new), then type 1 synchronisation of ``sync`` columns plus current/previous
    on *all* versions of each updated key from its newest row;
    ``previous_city`` is synchronised only where the city changed.  Only the
    historical column keeps per-version values.

    With ``first`` (the initial table: unique key, source column, city) the
    previous values are those of the initial load whatever was replaced; keys
    it lacks keep those of the replaced version."""
    u = upd.withColumnRenamed(source_col, cur_c)
    tracked6 = [cur_c if a == source_col else a for a in tracked]
    small = _small_batch(upd)
    touched, untouched = _split(dim, upd, key, small)
    cur = touched.filter(F.col(CUR))
    attrs = [c for c in dim.columns if c not in (EFF, EXP, CUR, prev_c, hist_c, prev_city)]
    kept = _chain(cur, u, key, tracked6, [c for c in attrs if c != key], small or None)
    if first is not None:
        known = _split(first, kept, key, small)[0].select(
            F.col(key).alias("_i_key"), F.col(source_col).alias("_i_source"), F.col(city_col).alias("_i_city"))
        found = F.col("_i_key").isNotNull()
        kept = kept.join(known, F.col(key) == F.col("_i_key"), "left").withColumns({
            f"prev_{cur_c}": F.when(found, F.col("_i_source")).otherwise(F.col(f"prev_{cur_c}")),
            f"prev_{city_col}": F.when(found, F.col("_i_city")).otherwise(F.col(f"prev_{city_col}"))})
        kept = materialize(kept.drop("_i_key", "_i_source", "_i_city"), "scd_kept_first")
    new_rows = kept.select(*[F.col(f"prev_{cur_c}").alias(prev_c) if c == prev_c
                             else F.col(f"prev_{city_col}").alias(prev_city) if c == prev_city
                             else F.col(cur_c).alias(hist_c) if c == hist_c
                             else F.col(c) for c in dim.columns])
    versions = _expire(touched, kept, key).unionByName(new_rows)
    # newest kept version per key drives the type 1 sync
    latest = kept.filter(F.col(CUR)).select(
        key, *[F.col(c).alias(f"_s_{c}") for c in list(sync) + [cur_c]],
        F.col(f"prev_{cur_c}").alias(f"_s_{prev_c}"),
        F.col(f"prev_{city_col}").alias("_s_prev_city"),
        differs(F.col(city_col), F.col(f"prev_{city_col}")).alias("_city_moved"), F.lit(True).alias("_sync"))
    j = versions.join(latest, key, "left")
    hit = F.coalesce(F.col("_sync"), F.lit(False))  # a new value may be NULL
    out = []
    for c in dim.columns:
        if c in list(sync) + [cur_c, prev_c]:
            out.append(F.when(hit, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
        elif c == prev_city:
            out.append(F.when(hit & F.col("_city_moved"), F.col("_s_prev_city")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return untouched.unionByName(j.select(*out))


# ---------------------------------------------------------------- reads
def as_of(dim: DataFrame, when: dt.date | str | Column, key: str | None = None,
          key_value=None) -> DataFrame:
    """Versions valid at ``when`` (both bounds inclusive)."""
    out = dim.filter(_lit_date(when).between(F.col(EFF), F.col(EXP)))
    if key is not None and key_value is not None:
        out = out.filter(F.col(key) == key_value)
    return out


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col(CUR))


def history(dim: DataFrame, key: str, key_value=None) -> DataFrame:
    out = dim if key_value is None else dim.filter(F.col(key) == key_value)
    return out.orderBy(key, EFF)


def as_of_join(facts: DataFrame, dim: DataFrame, key: str, when: str, take: Sequence[str],
               max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``facts`` with the ``take`` columns of the version of their ``key`` that
    is valid on the date ``when`` (NULL: no such version, no key or no date).
    ``take`` names columns of ``dim`` that ``facts`` lacks; intervals of a key
    do not overlap.

    A dimension proven small is broadcast, so the facts are not shuffled.
    Beyond that, versions and facts are put in one order per key and the last
    version is carried on to the facts after it: nothing is compared pairwise,
    and a hot key is cut by date ranges (``carry_forward``)."""
    version = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate([EFF, EXP, *take])]).alias("_version")
    taken = [F.col(f"_version.v{i + 2}").alias(c) for i, c in enumerate(take)]
    if proven_small(dim, max_rows):
        side = F.broadcast(dim.select(F.col(key).alias("_k"), version))
        valid = (F.col(key) == F.col("_k")) & F.col(when).between(F.col("_version.v0"), F.col("_version.v1"))
        return facts.join(side, valid, "left").select(*[F.col(c) for c in facts.columns], *taken)
    rows = facts.select(F.col(key).alias("_key"), F.col(when).alias("_day"), F.lit(1).alias("_kind"),
                        F.struct(*[F.col(c) for c in facts.columns]).alias("_fact"))
    known = dim.filter(F.col(EFF).isNotNull()).select(F.col(key).alias("_key"), F.col(EFF).alias("_day"),
                                                      F.lit(0).alias("_kind"), version)
    both = known.unionByName(rows, allowMissingColumns=True)
    found = carry_forward(both, ["_key"], ["_day", "_kind"], "_version", "_last").filter("_kind = 1")
    valid = F.col("_day") <= F.col("_last.v1")  # NULL where there is no day or no version
    return found.select("_fact.*", F.when(valid, F.col("_last")).alias("_version")).select(
        *[F.col(c) for c in facts.columns], *taken)
