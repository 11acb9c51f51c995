"""Queries that SQL can express, against DuckDB on the same tables."""

import pytest

from linkloom.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    got = queries()[name](spark, SF)
    res = duck(SF).execute(oracle_sql()[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == sorted(res.fetchall())


def test_columns_of_the_contract(spark):
    want = {
        "op2": "page_id url text n_chars",
        "op3": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        "op4": "doc_id size text_crc32 law shard slot grown_shard",
        "op5": "doc_id held_out score predicted",
        "op6": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
        "op7": "doc_id n_assign n_access n_hex base_sha256 spans",
        "op8": "doc_id held_out lang_pred score",
        "op9": "doc_id n_shingles component_id kept",
        "op10": "doc_id start n_tokens ids_crc32",
        "op11": "doc_id held_out n_tokens n_known train_tokens base_score score",
        "op12": "vec_id cluster distance cluster_inertia inertia centroid_sha256",
        "op13": "lang source part item value rank",
    }
    kinds = {"shard": "int", "grown_shard": "int", "predicted": "int", "score": "double", "held_out": "boolean",
             "base_failed": "boolean", "kept": "boolean", "url": "string", "text": "string", "law": "string",
             "base_sha256": "string", "spans": "string", "lang_pred": "string",
             "base_score": "double", "cluster": "int", "centroid_sha256": "string", "lang": "string",
             "source": "string", "part": "string", "item": "string", "rank": "int"}
    for name, run in queries().items():
        op = name.split("_")[0]
        if op in want:
            types = dict(run(spark, SF).dtypes)
            assert {c: types.get(c) for c in want[op].split()} == \
                {c: kinds.get(c, "bigint") for c in want[op].split()}, name
