"""Incremental file load: new files in a landing folder -> insert-only merge
into the target table (the body of the warehouse's daily task).

Structured Streaming does the bookkeeping a scheduled task needs: the file
source remembers which files were processed (in the checkpoint), and
``trigger(availableNow=True)`` processes everything new and stops, so a
scheduler (cron, an orchestrator) just starts the job.

An insert-only merge never changes existing rows, so each micro-batch only
*appends* the batch rows whose key the table lacks (``rows_to_insert``: the
batch is reduced to one row per key and stored, and its keys are checked against
a scan of the table's key columns alone).  ``foreachBatch`` is at-least-once: a
replayed batch finds its keys present and appends nothing.

CSV files follow the rules of ``sources.csv``.  Lines that do not load, and rows
without a full key (which no merge could recognise again), go to a side folder,
one per micro-batch, which a replay overwrites.
"""

from __future__ import annotations

from hashlib import md5
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.operators.changes import rows_to_insert
from tallyspark.sources.csv import CORRUPT, CsvFormat, raw_lines, typed_lines


def incremental_load(spark: SparkSession, landing_dir: str, schema: T.StructType,
                     table_path: str, keys: Sequence[str], checkpoint: str,
                     file_format: str = "parquet", max_files_per_batch: int | None = None,
                     order: Sequence[str] = (), rejects_path: str | None = None,
                     fmt: CsvFormat = CsvFormat(), on_error: str = "continue") -> DataFrame:
    """Process all files that arrived in ``landing_dir`` since the last run and
    merge them (insert-only, by ``keys``) into the Parquet table at
    ``table_path``.  Returns the table.

    Rejected rows are written as ``_corrupt_record`` (the raw line, or the row
    as JSON) below ``rejects_path`` (default: the table's path plus
    ``-rejects``); ``on_error='abort'`` fails the batch instead."""
    if on_error not in ("abort", "continue"):
        raise ValueError(on_error)
    is_csv = file_format == "csv"
    reader = spark.readStream
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    stream = (raw_lines(reader, landing_dir) if is_csv
              else reader.schema(schema).format(file_format).load(landing_dir))
    side = f"{(rejects_path or table_path.rstrip('/') + '-rejects')}/load={md5(checkpoint.encode()).hexdigest()[:12]}"

    def merge_batch(batch: DataFrame, epoch: int) -> None:
        if is_csv:
            rows = typed_lines(batch, schema, fmt)
        else:
            rows = batch.withColumns({CORRUPT: F.to_json(F.struct(*batch.columns)), "_ok": F.lit(True)})
        for k in keys:
            rows = rows.withColumn("_ok", F.col("_ok") & F.col(k).isNotNull())
        bad = rows.filter(~F.col("_ok")).select(CORRUPT)
        if on_error == "abort":
            first = bad.first()
            if first:
                raise ValueError(f"bad row: {first[0]}")
        else:
            bad.write.mode("overwrite").parquet(f"{side}/batch={epoch}")
        # the table's file list is fixed when this plan is built, so the
        # appended files are never read by the same job
        current = spark.read.schema(schema).parquet(table_path)
        good = rows.filter("_ok").select(*current.columns)
        rows_to_insert(current, good, keys, order).write.mode("append").parquet(table_path)

    q = (stream.writeStream.foreachBatch(merge_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(schema).parquet(table_path)


def rejected(spark: SparkSession, table_path: str, rejects_path: str | None = None) -> DataFrame:
    """Every rejected row of the loads of ``table_path`` so far."""
    return spark.read.schema(f"{CORRUPT} string").parquet(rejects_path or table_path.rstrip("/") + "-rejects")
