"""Column-expression helpers.  All return built-in Spark expressions, so they
stay inside whole-stage codegen; none of them is a UDF."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money contract: amounts are held as decimal(12,2) before any arithmetic, so
# sums are exact; reports hand the exact sum out as DOUBLE (the nearest double
# of the exact decimal, identical on any engine).
MONEY = "decimal(12,2)"
OPEN_END = dt.date(9999, 12, 31)


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    return col_(c).cast(MONEY)


def money_sum(c: str | Column) -> Column:
    """Exact sum of a money column (decimal), not yet handed out."""
    return F.sum(money(c))


def out_money(c: str | Column) -> Column:
    return col_(c).cast("double")


def cents(c: str | Column) -> Column:
    """Money as whole cents (bigint) -- exact and cheap to add up."""
    return (money(c) * 100).cast("long")


def avg_money_from_cents(total_cents: str, n: str) -> Column:
    """Average rounded half-up to the cent, by integer division only
    (identical on every engine, no double rounding); halves go away from zero."""
    half = f"(abs({total_cents}) * 2 + {n}) div ({n} * 2)"
    return (F.expr(f"sign({total_cents}) * ({half})") / F.lit(100.0)).cast("double")


def out_cents(c: str | Column) -> Column:
    """Whole cents handed out as the money double (same value as the exact
    decimal sum cast to double)."""
    return (col_(c) / F.lit(100.0)).cast("double")


def as_date(c: str | Column) -> Column:
    return F.to_date(col_(c))


def month_start(c: str | Column) -> Column:
    """date_trunc('month', d) as a DATE (Spark's date_trunc gives TIMESTAMP)."""
    return F.trunc(as_date(c), "month")


def day_before(c: str | Column) -> Column:
    """dateadd(day, -1, d) as a DATE."""
    return F.date_sub(col_(c), 1)


def differs(a: Column, b: Column, null_safe: bool = True) -> Column:
    """Attribute change test.  null_safe=True: NULL -> value is a change.
    null_safe=False: the warehouse's plain ``a <> b`` (a NULL side is no change)."""
    if null_safe:
        return ~a.eqNullSafe(b)
    return F.coalesce(a != b, F.lit(False))


def any_changed(pairs: Iterable[tuple[Column, Column]], null_safe: bool = True) -> Column:
    tests = [differs(a, b, null_safe) for a, b in pairs]
    return reduce(lambda x, y: x | y, tests) if tests else F.lit(False)


def full_name(first: str | Column, last: str | Column) -> Column:
    """concat(first, ' ', last); NULL when a part is NULL."""
    return F.concat(col_(first), F.lit(" "), col_(last))
