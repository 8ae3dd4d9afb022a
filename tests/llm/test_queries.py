"""The registered queries have the agreed columns, and one row where one is due."""

import os

import pytest

import __spark_entry__ as entry

DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_byte_level_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op2_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op3_exact_top_k": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op4_line_dedup": {"doc_id": "bigint", "n_lines": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op5_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op6_chat_formatting": {"conv_id": "bigint", "turn": "bigint", "new_role": "string", "rendered": "string"},
    "op7_suffix_array_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint",
                               "kept_sha256": "string"},
    "op8_sharding": {"doc_id": "bigint", "slot": "int", "shard": "string"},
    "op9_decontamination": {"doc_id": "bigint", "n_hits": "bigint", "item_ids": "array<bigint>", "contaminated": "int"},
    "op10_warc": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string",
                  "refers_to": "bigint"},
    "op11_prefix_trie": {"conv_id": "bigint", "depth": "bigint", "parent_conv_id": "bigint", "n_convs": "bigint",
                         "n_children": "bigint", "n_leaves": "bigint", "saved_tokens": "bigint", "ends_sha256": "string"},
    "op12_merkle_manifest": {"doc_id": "bigint", "leaf": "string", "subroot": "string", "root": "string",
                             "proof_sha256": "string", "folded_root": "string", "verified": "boolean"},
    "op13_imatch": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string",
                    "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
}


def test_all_are_registered():
    names = entry.queries()
    assert set(COLUMNS) | {"pipeline"} <= set(names) and set(entry.oracle_sql()) <= set(names)


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")
@pytest.mark.parametrize("name", COLUMNS)
def test_columns(spark, name):
    df = entry.queries()[name](spark, DIR)
    assert COLUMNS[name].items() <= dict(df.dtypes).items()
    if "doc_id" in df.columns:
        assert df.count() == spark.read.parquet(f"{DIR}/documents.parquet").count()
