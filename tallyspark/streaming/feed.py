"""A change feed that is appended by every change and consumed at own pace.

``append_changes`` stores the feed rows of one change (``change_feed`` between
the table before and after it) as files of their own below the feed's folder,
under the change's number.  A consumer reads the feed as a file stream with
``trigger(availableNow=True)``; its checkpoint is its offset, so every consumer
sees each change once, in as many reads as it likes, and a read with nothing new
hands out nothing.

Writing is replay-safe: a change that is already there is not written again (a
file stream would hand its new files out once more).  Consuming is too: every
micro-batch is written to a folder named after the consumer and the batch, which
a replay overwrites.
"""

from __future__ import annotations

from hashlib import md5
from typing import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.operators.changes import ACTION, IS_UPDATE

CHANGE = "_change"


def feed_schema(table: T.StructType) -> T.StructType:
    return T.StructType([*table.fields, T.StructField(ACTION, T.StringType()),
                         T.StructField(IS_UPDATE, T.BooleanType())])


def _written(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    try:
        return bool(spark.read.schema(schema).parquet(path).inputFiles())
    except AnalysisException:
        return False


def append_changes(feed: DataFrame, path: str, change: int) -> None:
    """Stores the rows of ``feed`` as change number ``change``; a change that is
    already stored stays as it is."""
    target = f"{path.rstrip('/')}/{CHANGE}={change:012d}"
    if not _written(feed.sparkSession, target, feed.schema):
        feed.write.mode("overwrite").parquet(target)


def read_feed(spark: SparkSession, path: str, table: T.StructType) -> DataFrame:
    """Every stored change, with its number in ``_change``."""
    schema = feed_schema(table).add(CHANGE, T.LongType())
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def consume(spark: SparkSession, path: str, table: T.StructType, checkpoint: str, sink: str,
            keep: Column | None = None, columns: Mapping[str, Column] | None = None) -> DataFrame:
    """Appends what this consumer has not read yet to its table at ``sink`` and
    gives the rows of this read.

    ``checkpoint`` is the consumer's offset: two consumers have two.  ``keep``
    takes a part of the feed (``new_rows`` only, one action); ``columns`` adds or
    replaces columns.  A read that fails is taken up by the next one; a batch
    that is replayed overwrites its own folder."""
    schema = feed_schema(table).add(CHANGE, T.LongType())
    stream = spark.readStream.schema(schema).option("basePath", path).parquet(path)
    if keep is not None:
        stream = stream.filter(keep)
    if columns:
        stream = stream.withColumns(dict(columns))
    out_schema = stream.schema
    folder = f"{sink.rstrip('/')}/consumer={md5(checkpoint.encode()).hexdigest()[:12]}"
    read: list[str] = []

    def write_batch(batch: DataFrame, epoch: int) -> None:
        target = f"{folder}/batch={epoch}"
        batch.write.mode("overwrite").parquet(target)
        read.append(target)

    query = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if not read:
        return spark.createDataFrame([], out_schema)
    return spark.read.schema(out_schema).parquet(*read)


def consumed(spark: SparkSession, sink: str, schema: T.StructType, keep: Sequence[str] | None = None) -> DataFrame:
    """Everything that consumers have written to ``sink``."""
    out = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(sink)
    return out.select(*keep) if keep else out
