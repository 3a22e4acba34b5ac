"""Report helpers: grouped measures over a fact with dimension look-ups,
top-k, ranking, best per group, above-average selection, purchase frequency,
overall average beside each row, wide report.

Scale notes
-----------
* ``revenue_by`` first proves the size of each look-up (``proven_small``;
  or the caller states a bound that holds by construction).  Look-ups proven
  small are broadcast and joined to the fact where it lies -- no shuffle of the
  fact for them -- and the fact is then aggregated map-side straight to the
  report's groups, so its only shuffle carries one partial row per group and
  task (a hot key costs one row per task).
* A look-up beyond the bound is never broadcast.  The fact is then
  aggregated by the foreign keys still needed *before* joining (Catalyst does
  not push an aggregate below a join): partial aggregation shrinks it before
  its shuffle, the join sees one row per key, and the grouped fact comes out
  hash-partitioned on the key, which a sort-merge join reuses.  AQE may still
  turn that join into a broadcast at run time and splits skewed partitions.
  Spark's static estimates are not trusted for this choice: a chain of joins
  is estimated as the product of its inputs, which once made it broadcast
  the pre-aggregated fact instead of a thousand-row dimension.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.columns import avg_money_from_cents, cents, out_cents
from tallyspark.operators.ordered import global_rank
from tallyspark.operators.sizing import BROADCAST_ROWS, broadcast_if_small


@dataclass(frozen=True)
class Measure:
    """A mergeable measure: partial value per fact key, merged after look-ups.

    kind: 'money' (exact sum, handed out as double), 'sum', 'count'
    (non-NULL values of ``column``) or 'rows' (count(*)).

    Money is added up as whole cents in a bigint: exact, and twice as fast as
    a decimal(12,2) sum, whose decimal(22,2) result is too wide for
    long-backed arithmetic.  The exact cent total divided by 100.0 is the
    nearest double of the exact decimal sum, so the handed-out value is the
    same.  Headroom is 9.2e16 currency units per group; ANSI mode raises on
    overflow instead of wrapping.  One-row totals over a whole fact use
    ``money_sum`` (decimal) instead."""
    name: str
    kind: str
    column: str | None = None

    def partial(self) -> Column:
        if self.kind == "money":
            return F.sum(cents(self.column)).alias(self.name)
        if self.kind == "sum":
            return F.sum(self.column).alias(self.name)
        if self.kind == "count":
            return F.count(self.column).alias(self.name)
        if self.kind == "rows":
            return F.count(F.lit(1)).alias(self.name)
        raise ValueError(self.kind)

    def merge(self) -> Column:
        merged = F.sum(self.name)
        if self.kind == "money":
            return out_cents(merged).alias(self.name)
        if self.kind in ("count", "rows"):
            return merged.cast("long").alias(self.name)
        return merged.alias(self.name)

    def finish(self) -> Column:
        """Hand-out form when no re-aggregation follows."""
        if self.kind == "money":
            return out_cents(self.name).alias(self.name)
        if self.kind in ("count", "rows"):
            return F.col(self.name).cast("long").alias(self.name)
        return F.col(self.name)


def money_m(name: str, column: str) -> Measure:
    return Measure(name, "money", column)


@dataclass(frozen=True)
class Lookup:
    """Inner look-up ``fact.fact_key = dim.dim_key``; ``dim`` should be
    projected to the key and the attributes needed.

    ``small``: True when the dimension is bounded by construction (a fixed
    list such as nation x region); None (default) = prove it at run time with
    ``proven_small``; False = never broadcast."""
    dim: DataFrame
    fact_key: str
    dim_key: str
    small: bool | None = None


def _join_lookup(cur: DataFrame, dim: DataFrame, lk: Lookup) -> DataFrame:
    if lk.dim_key != lk.fact_key:
        return cur.join(dim, cur[lk.fact_key] == dim[lk.dim_key], "inner")
    return cur.join(dim, lk.fact_key, "inner")


def revenue_by(fact: DataFrame, by: Sequence[str], measures: Sequence[Measure],
               lookups: Sequence[Lookup] = (), broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Grouped measures of ``fact`` by ``by`` columns, which may come from the
    fact or from looked-up dimensions (chains allowed: a later look-up may key
    on a column brought in by an earlier one).

    Plan: fact --broadcast joins of the leading look-ups proven small-->
    partial agg by (``by`` columns + fact keys of the remaining look-ups) -->
    joins of the remaining look-ups --> final agg by ``by``.  With every
    look-up small the first aggregate is already the report.  Between two
    remaining look-ups the partial values are merged by what is still needed.  A look-up whose
    key is itself a ``by`` column (a report at that dimension's grain) is
    joined after the aggregate, broadcast if proven small.
    """
    cur, rest = fact, list(lookups)
    first = None                 # (dim, broadcast?) of the first look-up not joined yet
    while rest:
        first = broadcast_if_small(rest[0].dim, broadcast_rows, rest[0].small)
        # a report at this dimension's grain (grouped by its key) aggregates
        # by the fact's key first: the join then sees one row per key and no
        # dimension attribute is hashed per fact row
        if not first[1] or rest[0].dim_key in by:
            break
        cur = _join_lookup(cur, first[0], rest.pop(0))
        first = None
    cols = set(cur.columns)
    pre_keys = list(dict.fromkeys([c for c in by if c in cols] +
                                  [lk.fact_key for lk in rest if lk.fact_key in cols]))
    grouped = cur.groupBy(*pre_keys).agg(*[m.partial() for m in measures])
    if not rest:
        return grouped.select(*by, *[m.finish() for m in measures])
    cur = grouped
    for i, lk in enumerate(rest):
        # the first one was checked above; later ones get their own check
        dim, _ = first if i == 0 else broadcast_if_small(lk.dim, broadcast_rows, lk.small)
        cur = _join_lookup(cur, dim, lk)
        if i + 1 < len(rest):  # fewer rows meet the next join: its key and the columns of the report found so far
            ahead = [c for c in dict.fromkeys([*by, *[x.fact_key for x in rest[i + 1:]]]) if c in cur.columns]
            cur = cur.groupBy(*ahead).agg(*[F.sum(m.name).alias(m.name) for m in measures])
    return cur.groupBy(*by).agg(*[m.merge() for m in measures])


def order_desc(measure: str, *keys: str) -> list[Column]:
    """``order by measure desc`` with NULLs last and ascending key tie-breakers."""
    return [F.col(measure).desc_nulls_last()] + [F.col(k).asc_nulls_last() for k in keys]


def top_by(grouped: DataFrame, measure: str, keys: Sequence[str], k: int,
           numbered: str | None = None) -> DataFrame:
    """Top-k rows by ``measure`` (arg-max for k=1).  Plans as
    TakeOrderedAndProject: every task keeps its k best, the driver merges
    k x tasks rows.  ``numbered`` adds row_number() over the k survivors."""
    top = grouped.orderBy(*order_desc(measure, *keys)).limit(k)
    if numbered:
        # the window runs over at most k rows (after the cut)
        w = Window.orderBy(*order_desc(measure, *keys))
        top = top.withColumn(numbered, F.row_number().over(w))
    return top


def rank_by(grouped: DataFrame, measure: str, name: str = "rank") -> DataFrame:
    """rank() by measure desc over the whole grouped result (gaps on ties),
    distributed (see operators.ordered)."""
    return global_rank(grouped, measure, name, descending=True)


def best_per_group(grouped: DataFrame, group: Sequence[str], measure: str,
                   keys: Sequence[str]) -> DataFrame:
    """Top-1 row per group.  Catalyst turns ``row_number() ... = 1`` into a
    WindowGroupLimit that also runs before the shuffle, so a hot group sends
    one row per task."""
    w = Window.partitionBy(*group).orderBy(*order_desc(measure, *keys))
    return (grouped.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn"))


def above_average(grouped: DataFrame, measure_cents: str) -> DataFrame:
    """Rows whose measure is above the average of all rows.

    The reference's cross join with a one-row aggregate is evaluated as a
    scalar subquery (``DataFrame.scalar()``): the total and the row count are
    one global aggregate, computed once (Spark merges the two scalars into one
    subquery) and inlined as a value -- no join at all.  The test
    ``x > sum/n`` is done as ``x * n > sum`` on whole cents: exact, no
    rounding of the average involved."""
    stats = grouped.agg(F.sum(measure_cents).alias("_tot"), F.count(F.lit(1)).alias("_n"))
    total, n = stats.select("_tot").scalar(), stats.select("_n").scalar()
    wide = "decimal(38,0)"  # x * n passes a bigint long before x or the total do
    return grouped.filter(F.col(measure_cents).cast("decimal(19,0)") * n.cast("decimal(18,0)") > total.cast(wide))


def with_global_avg(df: DataFrame, cents_col: str, name: str) -> DataFrame:
    """Each row beside the overall average (``avg(x) over ()``), rounded to the
    cent.  The average is a one-row aggregate inlined as a scalar subquery,
    instead of a window that would pull every row into one partition."""
    stats = df.agg(F.sum(cents_col).alias("_tot"), F.count(cents_col).alias("_n"))
    avg = stats.select(avg_money_from_cents("_tot", "_n").alias(name))
    return df.withColumn(name, avg.scalar())


def purchase_frequency(customers: DataFrame, sales: DataFrame, cust_key: str,
                       sale_key: str, count_col: str, name: str = "order_count",
                       keep_zero: bool = True) -> DataFrame:
    """Number of sales per customer.  keep_zero=True: customers without a sale
    appear with 0 (left join); False: the inner-join form drops them.
    Sales are counted per key first, then joined (one row per key)."""
    counts = sales.groupBy(sale_key).agg(F.count(count_col).alias(name))
    if keep_zero:
        joined = customers.join(counts, customers[cust_key] == counts[sale_key], "left")
        return joined.drop(sale_key).withColumn(name, F.coalesce(F.col(name), F.lit(0)).cast("long"))
    return customers.join(counts, customers[cust_key] == counts[sale_key], "inner").drop(sale_key)
