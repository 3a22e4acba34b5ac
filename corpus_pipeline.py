"""A training corpus from ``documents``: quality, near-duplicates, personal
data, mixing, packing.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept and calls one operator of ``tallyspark.llm``; all but the last return the
columns of ``docs``.  ``run`` writes each stage's result below
``spark.checkpoint.dir`` and reads it back for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import common, mil_quality, packing, pii_crf, raking, simhash

#: No SQL: trained models, tokenizers and XXH64 are beyond it (see tests/llm).
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the attention classifier rejects (score below
    its threshold)."""
    model = mil_quality.train(docs, common.read(spark, sf_dir, "labels"))
    scored = mil_quality.score(docs, model, common.whole_row(docs))
    return scored.where(F.col("__score") >= mil_quality.THRESHOLD).select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash component (3-word shingles, 2 bits)."""
    return simhash.keep_one(docs, words_per_shingle=3, max_bits=2)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every personal-data span by its kind; ``n_chars`` follows."""
    found = pii_crf.find(docs, pii_crf.train(docs), common.whole_row(docs))
    redacted = F.col("__redacted")
    new = {"text": redacted}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.char_length(redacted).cast(docs.schema["n_chars"].dataType)
    return found.select(*[F.coalesce(new.get(c, F.lit(None)), F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents to the raked shares; those of cells that need more
    than all their tokens are repeated."""
    copies = raking.drawn(docs, common.whole_row(docs)).where("__mix.copies > 0")
    return copies.select("doc", F.explode(F.sequence(F.lit(1), F.col("__mix.copies")))).select("doc.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed training sequences, token ids included."""
    return packing.pack_documents(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
          ("mixing", mixing), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
