"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.llm import (
    cover_tree,
    external_shuffle,
    license_scan,
    mil_quality,
    multi_index,
    packing,
    periodic_runs,
    permutation_index,
    pii_crf,
    raking,
    simhash,
    token_archive,
    warc,
)
from tallyspark.llm.common import read


def op1_permutation_index(spark, sf_dir):
    return permutation_index.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op2_external_shuffle(spark, sf_dir):
    return external_shuffle.shard_digest(read(spark, sf_dir, "documents"))


def op3_attention_mil(spark, sf_dir):
    return mil_quality.quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_inverted_multi_index(spark, sf_dir):
    return multi_index.near_duplicates(read(spark, sf_dir, "embeddings"), cosine=0.93)


def op5_simhash_pigeonring(spark, sf_dir):
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_raked_mix(spark, sf_dir):
    return raking.mix_report(read(spark, sf_dir, "documents"))


def op7_skip_chain_crf(spark, sf_dir):
    return pii_crf.personal_data(read(spark, sf_dir, "documents"))


def op8_diagonal_voting(spark, sf_dir):
    return license_scan.scan(read(spark, sf_dir, "documents"))


def op9_cost_packing(spark, sf_dir):
    return packing.piece_digest(read(spark, sf_dir, "documents"))


def op10_warc_revisits(spark, sf_dir):
    return warc.archive_digest(read(spark, sf_dir, "pages"))


def op11_cover_tree(spark, sf_dir):
    own = read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return cover_tree.mine(own.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_token_archive(spark, sf_dir):
    return token_archive.archive_digest(read(spark, sf_dir, "documents"))


def op13_periodic_runs(spark, sf_dir):
    return periodic_runs.run_digest(read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_permutation_index, op2_external_shuffle, op3_attention_mil, op4_inverted_multi_index, op5_simhash_pigeonring,
    op6_raked_mix, op7_skip_chain_crf, op8_diagonal_voting, op9_cost_packing, op10_warc_revisits,
    op11_cover_tree, op12_token_archive, op13_periodic_runs)}

OP10_SQL = """
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS payload_digest,
             octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages),
     f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes < 100 OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""

ORACLE_SQL = {"op6_raked_mix": raking.oracle_sql(), "op8_diagonal_voting": license_scan.oracle_sql(),
              "op10_warc_revisits": OP10_SQL}
