"""The registered queries: against their DuckDB SQL where they have one, over
whole tables; the contract's columns for all of them."""

from __future__ import annotations

import pytest

from tests.compare import compare, duckdb_connection
from tickwise.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op2_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op3_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op4_html_extraction": ["page_id", "url", "text", "n_chars"],
    "op5_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op6_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op7_url_filters": ["page_id", "host", "path", "rule", "verdict"],
    "op8_toxicity": ["doc_id", "severity"],
    "op9_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op10_jaccard_join": ["doc_id", "class_id", "n_links"],
    "op11_minhash_near_dedup": ["doc_id", "n_shingles", "component_id", "kept"],
    "op12_lexical_search": ["item_id", "rank", "doc_id", "score"],
    "op13_periodic_runs": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
}


def test_one_query_for_each_operator():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))
    assert set(ORACLES) <= set(QUERIES) and set(COLUMNS) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_columns_and_rows(spark, name):
    got = QUERIES[name](spark, SF)
    assert got.columns[: len(COLUMNS[name])] == COLUMNS[name]
    if name == "op12_lexical_search":
        items = spark.read.parquet(f"{SF}/benchmark.parquet").count()
        assert items <= got.count() <= 10 * items
        return
    table = "pages" if "page_id" in got.columns else "documents"
    n = spark.read.parquet(f"{SF}/{table}.parquet").count()
    assert got.count() >= n if name == "op1_packing" else got.count() == n


@pytest.mark.parametrize("name", list(ORACLES))
def test_sql(spark, name):
    report = compare(QUERIES[name](spark, SF), duckdb_connection(SF), ORACLES[name])
    assert report["ok"], report
