"""Registry of named queries: (spark, sf_dir) -> DataFrame, each with an
optional equivalent ANSI SQL text for the DuckDB oracle.

Oracle conventions (mirrored by the Spark side): money is summed exactly as
DECIMAL(12,2) and handed out as DOUBLE; counts are BIGINT; dates are DATE;
NULLs sort last; every output column is aliased.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name``; ``sql`` is its DuckDB oracle (None when
    the operator is not SQL-expressible and is tested against a brute-force
    fixture instead)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


def money_sum_sql(expr: str) -> str:
    return f"CAST(SUM(CAST({expr} AS DECIMAL(12,2))) AS DOUBLE)"


def cents_sql(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(12,2)) * 100 AS BIGINT)"
