"""Two-pass external shuffle into shards, with DataFrame functions only.

Pass one scatters the records uniformly into memory-sized buckets by a seeded
hash (one exchange of the whole records).  Pass two takes one bucket at a time,
puts it in hash order, applies a seeded Fisher-Yates shuffle (Spark's
``shuffle``) and writes the records.  The shuffled order of all records is the
buckets one after another; shards are equal stretches of that order, so their
row counts differ by at most one whatever the sizes of texts, sources or
groups of copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyspark.llm import common
from tallyspark.session import scratch_path

#: Target bytes of a bucket.  A task holds a few buckets at a time.
BUCKET_BYTES = 4 << 20
#: What a record weighs besides its text.
RECORD_BYTES = 64
MAX_PARTITIONS = 20_000


def running_offsets(counts: DataFrame, key: str, n: str, group: int = 4096) -> DataFrame:
    """``counts`` plus ``offset``: the sum of ``n`` over smaller ``key``.  In two
    levels, so that no window holds more than ``group`` rows or one row per
    ``group`` keys."""
    grouped = counts.withColumn("__g", F.floor(F.col(key) / group))
    above = Window.orderBy("__g").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("__g").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    tops = (grouped.groupBy("__g").agg(F.sum(n).alias("__n"))
            .select("__g", F.coalesce(F.sum("__n").over(above), F.lit(0)).alias("__top")))
    return (grouped.withColumn("__in", F.coalesce(F.sum(n).over(within), F.lit(0)))
            .join(tops, "__g").withColumn("offset", F.col("__top") + F.col("__in"))
            .drop("__g", "__in", "__top"))


def write_shards(docs: DataFrame, n_shards: int, path: str, seed: int = 1, text: str = "text",
                 bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Writes ``docs`` as ``path/shard=<n>/`` in shuffled order and returns the
    written table: ``shard``, ``slot`` (gapless from 0 in each shard) and
    ``doc``, the whole record (so no input column can clash).

    Null texts weigh nothing, repeated rows are scattered by their place in
    the input, an empty table writes no shard."""
    spark = common.ready(docs.sparkSession)
    # Identity comes from docs before anything else is derived from it.
    whole = common.with_identity(docs, common.whole_row(docs))
    rows = whole.select("doc", "__r", F.xxhash64(F.lit(seed), *[
        F.col(f"doc.`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))
    ], "__r").alias("h"))
    weight = F.coalesce(F.octet_length(F.col(f"doc.`{text}`")), F.lit(0)).cast("long") + RECORD_BYTES
    total = rows.agg(F.sum(weight)).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    # one more mixing step: h also orders the bucket, so it must not be constant in its low bits there
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(buckets)).cast("long"))
    counts = rows.groupBy("bucket").agg(F.count("*").alias("n"))
    offsets = common.stored(running_offsets(counts, "bucket", "n"), "shard-offsets")
    n = offsets.agg(F.sum("n")).first()[0] or 0

    def in_hash_order(a, b):
        return (F.when(a["h"] < b["h"], -1).when(a["h"] > b["h"], 1)
                .when(a["__r"] < b["__r"], -1).when(a["__r"] > b["__r"], 1).otherwise(0))

    partitions = min(buckets, MAX_PARTITIONS)
    full = (rows.repartition(partitions, "bucket").groupBy("bucket")
            .agg(F.collect_list(F.struct("h", "__r", "doc")).alias("all")))
    # The merge join leaves the buckets of a partition in order, so the seeded
    # generator deals each of them the same permutation on every run.
    placed = (full.join(offsets.select("bucket", "offset").hint("merge"), "bucket")
              .select("offset", F.shuffle(F.array_sort("all", in_hash_order), seed).alias("all"))
              .select("offset", F.posexplode("all").alias("pos", "rec"))
              .select((F.col("offset") + F.col("pos")).alias("at"), "rec.doc"))
    shard = F.expr(f"at * {n_shards} div {max(n, 1)}")
    first = F.expr(f"(shard * {n} + {n_shards - 1}) div {n_shards}")
    (placed.withColumn("shard", shard.cast("int")).select("shard", (F.col("at") - first).alias("slot"), "doc")
     .write.partitionBy("shard").parquet(path))
    schema = T.StructType([T.StructField("slot", T.LongType()),
                           T.StructField("doc", T.StructType(docs.schema.fields)),
                           T.StructField("shard", T.IntegerType())])
    return spark.read.schema(schema).parquet(path)


def shard_digest(docs: DataFrame, n_shards: int = 24, seed: int = 1) -> DataFrame:
    """The contract's row per document, read back from the written shards."""
    shards = write_shards(docs, n_shards, scratch_path(common.ready(docs.sparkSession), "shards"), seed)
    text = common.text_or_empty(F.col("doc.text"))
    return shards.select(
        F.col("doc.doc_id").alias("doc_id"), (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
