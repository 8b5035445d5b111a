"""Registered queries over whole tables: SQL where there is some, shapes and ranges for all."""

import pytest
from oracle import SF, assert_same

import __spark_entry__
from rosterspark.llm.queries import ORACLE_SQL, QUERIES

COLUMNS = {
    1: {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    2: {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    3: {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    4: {"doc_id": "bigint", "n_tokens": "bigint", "log_prob": "double"},
    5: {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    6: {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    7: {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    8: {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    9: {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    10: {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    11: {"doc_id": "bigint", "leaf": "string", "subroot": "string", "root": "string", "proof_sha256": "string", "folded_root": "string", "verified": "boolean"},
    12: {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    13: {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"},
}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    assert_same(spark, QUERIES[name], ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(spark, name):
    n = int(name[2:].split("_")[0])
    df = QUERIES[name](spark, SF)
    kinds = dict(df.dtypes)
    assert COLUMNS[n].items() <= kinds.items()
    table = {1: "pages", 2: None, 8: None, 13: None}.get(n, "documents")
    if table:
        assert df.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries()) and len(QUERIES) == 13
