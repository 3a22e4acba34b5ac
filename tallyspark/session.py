"""Session construction and the shared scratch location.

On a cluster the operator names a shared folder in ``spark.checkpoint.dir``;
every written intermediate (checkpoints, stored aggregates, snapshots) goes
below it.  Only when it is unset (local tests) do we pick a fresh folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings every job relies on: UTC dates, ANSI casts, AQE re-planning
# (coalescing, skew-join splitting, sort-merge -> broadcast at run time).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tallyspark", extra: dict | None = None) -> SparkSession:
    """Local/test session.  On a cluster use the session the platform gives."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session(spark)
    return spark


def ensure_session(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators depend on and make sure a reliable
    checkpoint folder exists (the cluster's, or a fresh one in local mode).
    Done once per session object."""
    if getattr(spark, "_tally_ready", False):
        return spark
    for k, v in SESSION_DEFAULTS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    spark._tally_ready = True
    return spark


_LOCAL_FALLBACK: dict[int, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder: the session's ``spark.checkpoint.dir``
    (a shared folder on a cluster).  Only a local session without one gets a
    fresh local folder."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- Spark Connect: no driver-side context
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        key = id(sc)
        if key not in _LOCAL_FALLBACK:
            _LOCAL_FALLBACK[key] = tempfile.mkdtemp(prefix="tallyspark-ckpt-")
        configured = _LOCAL_FALLBACK[key]
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint location for written
    tables (stored aggregates, snapshots, CSV exports)."""
    base = checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "tables", f"{name}-{uuid.uuid4().hex[:12]}")
