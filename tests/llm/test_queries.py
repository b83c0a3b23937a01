"""The registered queries, against DuckDB where there is SQL, and their columns."""

import duckdb
import pytest

import __spark_entry__ as entry
from vitalgrain.llm import queries

COLUMNS = {
    "op1_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op2_bpe_codec": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op3_packing": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op4_fingerprints": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
    "op5_language": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op6_exact_dedup": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    "op7_sharding": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op8_lm_scoring": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
    "op9_near_dedup": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op10_warc": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
    "op11_embedding_dedup": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op12_spelling": {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"},
    "op13_lexical_search": {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"},
}


def test_all_are_registered():
    assert set(queries.QUERIES) == set(COLUMNS) <= set(entry.queries()) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    got = dict(df.dtypes)
    assert {k: got[k] for k in COLUMNS[name]} == COLUMNS[name]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.sql(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    df = queries.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    want = con.sql(f"select {', '.join(columns)} from ({queries.ORACLE_SQL[name]})").fetchall()
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
