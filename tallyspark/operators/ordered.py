"""Globally ordered operators that must not collapse into one partition:
``rank() over (order by m desc)``, ``row_number()`` surrogate keys and a
ROWS running sum over a whole fact table.

A window without PARTITION BY makes Spark move every row into a single task.
Here the work is split in two passes instead:

1. ``repartitionByRange`` on the order key -- always made unique (keys for
   row numbers and running sums must be unique; rank appends a row id), so a
   hot value can never pile up in one task -- tag each row with its partition
   id and ``checkpoint()`` it to the shared checkpoint folder, so the range cut
   is fixed (the range bounds come from sampling; a recomputation could cut
   elsewhere) and the lineage is cut.
2. Per-partition row counts / sums -- one row per partition, a bound we choose
   -- are turned into offsets with a prefix sum and broadcast back (for rank
   also the start rank of a tie group that continues from earlier
   partitions).  Row numbers are a row's position in its sorted partition plus
   the offset, so the rows are shuffled once; running sums and ranks take an
   ordinary window per partition id, plus its offset.

There is one implementation for every size, and no value leaves the JVM: NULL,
NaN, big integers and far dates come out as a single window would give them.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.operators.sizing import proven_small
from tallyspark.session import checkpoint_dir

_PID = "_tally_pid"
_OFF = "_tally_offset"
_TB = "_tally_tiebreak"
_POS = "_tally_pos"

# A batch proven (by ``proven_small``) to hold at most this many rows finds its
# neighbours with a window per key; the rows are the same beyond it, where a hot
# key's rows must not meet in one task.
SMALL_ROWS = 200_000


def _order_exprs(order: Sequence[tuple[str, bool]]) -> list[Column]:
    """(column, descending) pairs -> sort expressions with NULLs last."""
    return [F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_last()
            for c, desc in order]


def _range_checkpoint(df: DataFrame, order: Sequence[tuple[str, bool]],
                      num_partitions: int | None) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    exprs = _order_exprs(order)
    ranged = (df.repartitionByRange(num_partitions, *exprs) if num_partitions
              else df.repartitionByRange(*exprs))
    return ranged.withColumn(_PID, F.spark_partition_id()).checkpoint(eager=True)


def _numbered_checkpoint(df: DataFrame, order: Sequence[tuple[str, bool]], num_partitions: int | None) -> DataFrame:
    """``_range_checkpoint`` of partitions sorted by ``order``, with each row's
    position in its partition (from 1) in ``_tally_pos``: the lower 33 bits of
    ``monotonically_increasing_id`` number the rows of a task as they come."""
    checkpoint_dir(df.sparkSession)
    exprs = _order_exprs(order)
    ranged = (df.repartitionByRange(num_partitions, *exprs) if num_partitions else df.repartitionByRange(*exprs))
    place = F.monotonically_increasing_id()
    return (ranged.sortWithinPartitions(*exprs).withColumn(_POS, place)
            .select(*df.columns, F.shiftright(_POS, 33).cast("int").alias(_PID),
                    (F.col(_POS).bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias(_POS)).checkpoint(eager=True))


def _offsets(cp: DataFrame, value: str | None) -> DataFrame:
    """Rows, or the sum of ``value`` (NULL while there is none), of all earlier
    partitions, per partition id.  One row per partition: small by
    construction, safe to broadcast."""
    own = F.count(F.lit(1)) if value is None else F.sum(value)
    w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    return cp.groupBy(_PID).agg(own.cast("long").alias("_own")).select(_PID, F.sum("_own").over(w).alias(_OFF))


def _rank_starts(cp: DataFrame, measure: str, descending: bool) -> DataFrame:
    """Per partition: rows before it (offset) and the rank of its first tie
    group.  Ties may span partitions (the range cut is on measure + a unique
    tie-breaker, so a huge tie group is split across tasks): the rank is one
    more than the rows before the partition that are not of that group.

    Works on one summary row per partition (a count we choose, so it is
    bounded): first and last value, rows, rows of the last tie group."""
    m = F.col(measure)
    ends = cp.groupBy(_PID).agg(
        (F.max(m) if descending else F.min(m)).alias("_first"),
        F.when(F.count_if(m.isNull()) == 0, F.min(m) if descending else F.max(m)).alias("_last"),
        F.count(F.lit(1)).alias("_n"))
    tail = (cp.select(_PID, measure).join(F.broadcast(ends.select(_PID, "_last")), _PID)
            .groupBy(_PID).agg(F.count_if(m.eqNullSafe(F.col("_last"))).alias("_last_n")))
    w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    summ = ends.join(tail, _PID).withColumn(_OFF, F.coalesce(F.sum("_n").over(w), F.lit(0)))
    before = summ.select(F.col(_PID).alias("_q"), F.col("_last").alias("_l"), F.col("_last_n").alias("_same"))
    return (summ.join(before, F.col("_first").eqNullSafe(F.col("_l")) & (F.col("_q") < F.col(_PID)), "left")
            .groupBy(_PID, _OFF).agg(F.coalesce(F.sum("_same"), F.lit(0)).alias("_same"))
            .select(_PID, _OFF, (F.col(_OFF) - F.col("_same") + 1).alias("_start")))


def _sequence(df: DataFrame, order: Sequence[tuple[str, bool]], name: str, kind: str,
              value: str | None = None, num_partitions: int | None = None) -> DataFrame:
    within = Window.partitionBy(_PID).orderBy(*_order_exprs(order))
    off = F.col(_OFF)
    if kind == "rank":
        # unique tie-breaker so that a large tie group can be cut into several
        # range partitions; rank does not depend on the order inside a tie
        cp = _range_checkpoint(df.withColumn(_TB, F.monotonically_increasing_id()), [*order, (_TB, False)],
                               num_partitions)
        offs = _rank_starts(cp, *order[0])
        local = F.rank().over(within)
        res = F.when(local == 1, F.col("_start")).otherwise(off + local)
    elif kind == "row_number":
        cp = _numbered_checkpoint(df, order, num_partitions)
        offs = _offsets(cp, None)
        res = F.coalesce(off, F.lit(0)) + F.col(_POS)
    else:
        cp = _range_checkpoint(df, order, num_partitions)
        offs = _offsets(cp, value)
        so_far = F.sum(value).over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        res = F.coalesce(so_far + off, so_far, off)
    return (cp.join(F.broadcast(offs), _PID)
            .select(*[F.col(c) for c in df.columns], res.cast("long").alias(name)))


def global_rank(df: DataFrame, measure: str, name: str = "rank", descending: bool = True,
                num_partitions: int | None = None) -> DataFrame:
    """``rank() over (order by measure desc)`` without a single-partition window."""
    return _sequence(df, [(measure, descending)], name, "rank", num_partitions=num_partitions)


def assign_keys(df: DataFrame, order_cols: Sequence[str], name: str, start: int = 1,
                num_partitions: int | None = None) -> DataFrame:
    """Dense surrogate keys ``start, start+1, ...`` in natural-key order
    (``autoincrement start 1 increment 1``).  order_cols must be unique."""
    out = _sequence(df, [(c, False) for c in order_cols], name, "row_number",
                    num_partitions=num_partitions)
    return out if start == 1 else out.withColumn(name, F.col(name) + (start - 1))


def continue_keys(existing: DataFrame, new_rows: DataFrame, order_cols: Sequence[str],
                  name: str) -> DataFrame:
    """Keys for rows added later continue from ``max(key)`` of the table
    (a one-row aggregate read as a scalar)."""
    top = existing.agg(F.max(name)).first()[0] or 0
    return assign_keys(new_rows, order_cols, name, start=int(top) + 1)


def running_total(df: DataFrame, order_cols: Sequence[str], cents_col: str, name: str,
                  num_partitions: int | None = None) -> DataFrame:
    """``sum(x) over (order by order_cols rows between unbounded preceding and
    current row)`` on a whole fact table.  ``order_cols`` must end in a unique
    tie-breaker; the measure is given in whole cents (exact bigint addition)."""
    return _sequence(df, [(c, False) for c in order_cols], name, "running",
                     value=cents_col, num_partitions=num_partitions)


def with_neighbors(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                   prev_cols: Sequence[str] = (), next_cols: Sequence[str] = (),
                   small_rows: int = SMALL_ROWS, known_small: bool | None = None) -> DataFrame:
    """``lag``/``lead`` within each key, in ``order_cols`` order: adds
    ``prev_<c>`` / ``next_<c>`` (NULL at the ends of a key) and ``_has_prev`` /
    ``_has_next``.

    Small inputs (checked) use ``Window.partitionBy(keys)``.  Larger ones must
    not put all rows of a hot key into one task: every row gets a global
    sequence number g over (keys, order, row id) -- the distributed
    ``row_number`` above -- and the neighbours are equi-joins on ``g - 1`` and
    ``g + 1`` (with the same key).  g is unique, so those joins spread evenly
    over the tasks whatever the key distribution."""
    if known_small or (known_small is None and proven_small(df, small_rows)):
        w = Window.partitionBy(*keys).orderBy(*order_cols)
        out = df.select("*", *[F.lag(c).over(w).alias(f"prev_{c}") for c in prev_cols],
                        *[F.lead(c).over(w).alias(f"next_{c}") for c in next_cols],
                        F.lag(F.lit(1)).over(w).isNotNull().alias("_has_prev"),
                        F.lead(F.lit(1)).over(w).isNotNull().alias("_has_next"))
        return out
    tb = "_tally_nb_id"
    seq = assign_keys(df.withColumn(tb, F.monotonically_increasing_id()),
                      [*keys, *order_cols, tb], "_g")
    base = seq.alias("x")
    prev = seq.select(*[F.col(k).alias(f"_p_{k}") for k in keys], (F.col("_g") + 1).alias("_pg"),
                      *[F.col(c).alias(f"prev_{c}") for c in prev_cols], F.lit(True).alias("_has_prev"))
    nxt = seq.select(*[F.col(k).alias(f"_n_{k}") for k in keys], (F.col("_g") - 1).alias("_ng"),
                     *[F.col(c).alias(f"next_{c}") for c in next_cols], F.lit(True).alias("_has_next"))
    pc = F.col("x._g") == F.col("_pg")
    nc = F.col("x._g") == F.col("_ng")
    for k in keys:
        pc = pc & F.col(f"x.{k}").eqNullSafe(F.col(f"_p_{k}"))
        nc = nc & F.col(f"x.{k}").eqNullSafe(F.col(f"_n_{k}"))
    # sort-merge: a side of few shuffled bytes can be wide rows that would all pass the driver
    j = base.join(prev.hint("merge"), pc, "left").join(nxt.hint("merge"), nc, "left")
    return j.select(*[F.col(f"x.{c}") for c in df.columns],
                    *[F.col(f"prev_{c}") for c in prev_cols], *[F.col(f"next_{c}") for c in next_cols],
                    F.coalesce(F.col("_has_prev"), F.lit(False)).alias("_has_prev"),
                    F.coalesce(F.col("_has_next"), F.lit(False)).alias("_has_next"))


def carry_forward(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], value: str, name: str,
                  num_partitions: int | None = None) -> DataFrame:
    """``last(value) ignore nulls over (partition by keys order by order_cols
    rows up to the current one)`` for a key of any size: the rows are cut into
    ranges of (keys, order), so a hot key lies in several of them; within a
    range a window per key carries the value on, and what the key's earlier
    ranges end with (one row per range) is handed to its first rows.

    ``order_cols`` hold no NULL where ``value`` has one to carry.  A NULL key
    matches nothing: its rows get NULL."""
    filled = F.lit(True)
    for k in keys:
        filled = filled & F.col(k).isNotNull()
    tagged = df.withColumn(_TB, F.monotonically_increasing_id())
    cp = _range_checkpoint(tagged, [(c, False) for c in [*keys, *order_cols, _TB]], num_partitions)
    key = F.struct(*[F.col(k) for k in keys])
    place = F.when(filled & F.col(value).isNotNull(), F.struct(*[F.col(c) for c in [*keys, *order_cols, _TB]]))
    ends = cp.groupBy(_PID).agg(F.min(F.when(filled, key)).alias("_first"),
                                F.max_by(F.struct(key.alias("key"), F.col(value).alias("value")), place).alias("_end"))
    tails = ends.filter(F.col("_end").isNotNull()).select(F.col(_PID).alias("_q"), "_end")
    held = ends.select(_PID, "_first").join(tails, (F.col("_first") == F.col("_end.key")) & (F.col("_q") < F.col(_PID)))
    held = held.groupBy(_PID, "_first").agg(F.max_by("_end.value", "_q").alias("_carried"))
    within = (Window.partitionBy(_PID, *keys).orderBy(*[F.col(c).asc_nulls_last() for c in [*order_cols, _TB]])
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    own = cp.withColumn("_own", F.last(value, ignorenulls=True).over(within))
    j = own.join(F.broadcast(held), _PID, "left")
    carried = F.when(key == F.col("_first"), F.col("_carried"))
    return j.select(*[F.col(c) for c in df.columns], F.when(filled, F.coalesce("_own", carried)).alias(name))


def running_state(totaled: DataFrame, order_cols: Sequence[str], name: str) -> DataFrame:
    """The state that a running sum is continued from, one row: the last place
    in ``order_cols`` order and the total there (no row for an empty frame)."""
    last = F.struct(*[F.col(c) for c in order_cols])
    return (totaled.agg(F.max(last).alias("last"), F.max_by(F.col(name), last).alias("total"))
            .filter(F.col("last").isNotNull()))


def continue_running_total(state: DataFrame, new_rows: DataFrame, order_cols: Sequence[str], cents_col: str, name: str,
                           num_partitions: int | None = None) -> DataFrame:
    """``running_total`` of rows that come after all earlier ones: only they
    are ordered and summed, from ``state`` (``running_state`` of what is stored).
    A row that is not after the last stored one fails."""
    at = state.first()  # one row
    out = running_total(new_rows, order_cols, cents_col, name, num_partitions)
    if at is None:
        return out
    last = F.struct(*[F.lit(v).cast(new_rows.schema[c].dataType).alias(c)
                      for c, v in zip(order_cols, at["last"], strict=True)])
    late = F.raise_error(F.lit("a row is not later than the stored running sum")).cast("long")
    after = F.struct(*[F.col(c) for c in order_cols]) > last
    total = F.lit(at["total"]).cast("long")
    return out.withColumn(name, F.when(after, F.coalesce(F.col(name) + total, F.col(name), total)).otherwise(late))
