"""Registered queries against their SQL, and what the registry promises."""

import re

import pytest

from reelrank.llm.queries import QUERIES, SQL
from tests.oracle import compare, duck


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_small, name):
    ok, message = compare(QUERIES[name](spark, sf_small), SQL[name], duck(sf_small))
    assert ok, message


CONTRACT = {
    "op2_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op3_hilbert_shards": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op4_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op5_hnsw_near_dedup": ["vec_id", "n_links", "component_id", "kept"],
    "op6_simhash_near_dedup": ["doc_id", "fingerprint", "component_id"],
    "op7_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op9_url_filter": ["page_id", "host", "path", "rule", "verdict"],
    "op10_html_extraction": ["page_id", "url", "text", "n_chars"],
    "op11_periodic_runs": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"],
    "op12_repair_shards": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op13_laesa_codes": ["vec_id", "code", "error", "label_error", "codebooks_sha256"],
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_columns_and_whole_tables(spark, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    assert df.columns[:len(CONTRACT[name])] == CONTRACT[name]
    source = "embeddings" if re.search("hnsw|laesa", name) else "pages" if re.search("url|html", name) else "documents"
    assert df.count() == spark.read.parquet(f"{sf_small}/{source}.parquet").count()
