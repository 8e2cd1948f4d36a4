"""The registered queries on the smallest generated tables, and their SQL twins."""

import os

import duckdb
import pytest

from tidemark.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(SQL[name]).df()
    got = QUERIES[name](spark, SF).toPandas()[list(want.columns)]

    def rows(frame):
        return sorted(str([None if x is None or x != x else int(x) if isinstance(x, float) else x for x in r]) for r in frame.values.tolist())

    assert rows(got) == rows(want)


def test_every_query_has_its_contract_columns(spark):
    columns = {
        "op1_html": "page_id url text n_chars", "op2_chat": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
        "op4_substrings": "doc_id n_words n_removed kept_sha256", "op5_mixing": "doc_id size source_size target taken",
        "op7_pq": "vec_id n_links component_id kept", "op8_winnowing": "doc_id n_words n_hit n_items items_sha256 contaminated",
        "op9_tokenfiles": "doc_id start n_tokens ids_crc32", "op10_toxicity": "doc_id held_out score predicted",
        "op11_threshold": "anchor_id positive_id rank negative_id positive_score negative_score",
        "op12_repair": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
        "op13_warc": "page_id payload_bytes payload_digest record_type refers_to",
        "op3_quality": "doc_id keep", "op6_bagminhash": "doc_id class_id",
    }
    assert set(columns) == set(QUERIES) - {"pipeline"}
    for name, want in columns.items():
        assert set(want.split()) <= set(QUERIES[name](spark, SF).columns), name
