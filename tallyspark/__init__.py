"""tallyspark: warehouse analytics re-expressed as PySpark DataFrame jobs.

Sub-packages
------------
sources    typed CSV loading with reject output, table access, snapshot sinks
functions  column-expression helpers (money, dates, change predicates)
operators  reports, distributed ordered operators, table changes, SCD,
           dimensional modelling, data quality, stored aggregates
streaming  incremental file load (Structured Streaming, availableNow)
plans      the query catalogue bound to the driver's test tables
"""

from tallyspark.session import build_session, ensure_session, scratch_path

__all__ = ["build_session", "ensure_session", "scratch_path"]
