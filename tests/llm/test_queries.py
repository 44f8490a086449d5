"""The registered queries on the smallest data set: columns, rows, and SQL where there is some."""

import pytest

import __spark_entry__ as entry
from check import compare, connect
from precinct.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import SMALL

COLUMNS = {
    "op1_pseudonyms": {"doc_id", "text"},
    "op2_compression_quality": {"doc_id", "held_out", "score", "predicted"},
    "op3_best_fit_shards": {
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    },
    "op4_cross_parsing": {"doc_id", "held_out", "lang_pred", "score"},
    "op5_license_scan": {"doc_id", "n_notices", "families", "probability"},
    "op6_mix_blocks": {"doc_id", "size", "source_size", "target", "taken"},
    "op7_top_k": {"query_id", "rank", "vec_id", "score"},
    "op8_byte_bpe": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op9_metric_join": {"doc_id", "n_shingles", "component_id"},
    "op10_quality_rules": {
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    },
    "op11_hard_negatives": {
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    },
    "op12_lexical_search": {"item_id", "rank", "doc_id", "score"},
    "op13_decontamination": {
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    },
}


def test_all_are_registered():
    assert set(COLUMNS) == set(QUERIES)
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_gives_its_rows(spark, name):
    frame = QUERIES[name](spark, SMALL)
    assert COLUMNS[name] <= set(frame.columns)
    rows = frame.toPandas()
    searches = {"op7_top_k": 50, "op11_hard_negatives": 250, "op12_lexical_search": 400}
    wanted = searches.get(name) or spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert len(rows) == wanted
    if name not in searches:
        assert rows["doc_id"].is_unique


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_its_sql(spark, name):
    good, note = compare(spark, connect(SMALL), SMALL, name)
    assert good, note
