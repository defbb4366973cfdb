"""The registered queries of this folder on the smallest tables."""

import pytest
from compare import compare, duckdb_conn
from conftest import SF_SMALL

from tidemark.llm.oracle import ORACLES
from tidemark.llm.queries import QUERIES

COLUMNS = {
    "op1_decontaminate": {"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"},
    "op2_quality": {"doc_id", "held_out", "score", "predicted"},
    "op3_best_fit_packing": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
    "op4_html_extract": {"page_id", "url", "text", "n_chars"},
    "op5_token_counts": {"doc_id", "n_bytes", "n_tokens", "over_limit"},
    "op6_suffix_dedup": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op7_top_k": {"query_id", "rank", "vec_id", "score"},
    "op8_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op9_near_duplicates": {"doc_id", "n_shingles", "component_id", "kept"},
    "op10_url_filter": {"page_id", "host", "path", "rule", "verdict"},
    "op11_token_alignment": {"doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"},
    "op12_merkle_manifest": {"doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"},
    "op13_passage_dedup": {"doc_id", "n_words", "n_removed", "kept_sha256"},
}


def test_one_query_for_each_operator():
    assert set(QUERIES) == set(COLUMNS) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    out = QUERIES[name](spark, SF_SMALL)
    assert set(out.columns) == COLUMNS[name]
    assert out.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, name):
    r = compare(spark, duckdb_conn(SF_SMALL), name, QUERIES[name], ORACLES[name], SF_SMALL)
    assert r["cols"] and r["rows"][0] == r["rows"][1] and r["values"], r
