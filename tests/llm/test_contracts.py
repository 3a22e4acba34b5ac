"""The columns and types that the queries without SQL have to return."""

import os

import pytest

from tallyspark.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")

COLUMNS = {
    "op1_permutation_index": "query_id bigint, rank int, vec_id bigint, score double",
    "op2_external_shuffle": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, "
                            "grown_shard int",
    "op3_attention_mil": "doc_id bigint, held_out boolean, score double, predicted int",
    "op4_inverted_multi_index": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op5_simhash_pigeonring": "doc_id bigint, fingerprint string, component_id bigint",
    "op7_skip_chain_crf": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
                          "base_sha256 string, spans string",
    "op9_cost_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
                        "sequence_id bigint, offset bigint",
    "op11_cover_tree": "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, "
                       "negative_score bigint",
    "op12_token_archive": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op13_periodic_runs": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, "
                          "exponent_milli bigint, runs_sha256 string, collapsed_sha256 string",
}


@pytest.mark.parametrize("name", COLUMNS)
def test_contract_columns(spark, name):
    got = dict(queries.QUERIES[name](spark, SF).dtypes)
    for column in COLUMNS[name].split(", "):
        n, t = column.split(" ")
        assert got[n] == t
