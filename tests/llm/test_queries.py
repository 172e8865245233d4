"""The queries: columns of the contract, and rows of their SQL where there is one."""

import zlib

import pytest

from screenspark.llm import queries
from tests.compare import SF, differences

COLUMNS = {
    "op1_near_vectors": "vec_id n_links component_id kept", "op2_bpe": "doc_id n_tokens ids_sha256 decoded_sha256", "op3_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op4_licenses": "doc_id n_words n_base first_word last_word base_labels labels score", "op5_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op6_warc": "page_id payload_bytes payload_digest record_type refers_to", "op7_decontaminate": "doc_id item_id edits", "op8_quality": "doc_id held_out score predicted",
    "op9_jaccard": "doc_id n_shingles component_id", "op10_langid": "doc_id held_out lang_pred score",
    "op11_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256", "op12_exact_dedup": "doc_id keep_id group_size kept text_sha256",
}


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_equals_sql(spark, name):
    assert not differences(queries.queries()[name](spark, SF), queries.oracle_sql()[name], SF)


ROWS = {"op1_near_vectors": "embeddings", "op6_warc": "pages"}


@pytest.mark.parametrize("name", COLUMNS)
def test_query_columns(spark, name):
    """As registered: the columns of the contract, and a row for each of the table's."""
    found = queries.queries()[name](spark, SF)
    rows = found.collect()
    assert found.columns == COLUMNS[name].split()
    if name not in ("op7_decontaminate", "op11_prefix_trie"):
        assert len(rows) == spark.read.parquet(f"{SF}/{ROWS.get(name, 'documents')}.parquet").count()
    for modulus, rest, held in ((4, 2, "op8_quality"), (5, 0, "op10_langid")):
        if name == held:
            assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == rest) and 0 <= r.score <= 1 for r in rows)
    if name == "op8_quality":
        assert all(r.predicted == int(r.score >= 0.7) for r in rows)


def test_all_are_registered():
    assert list(queries.queries()) == list(COLUMNS)
