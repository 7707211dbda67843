"""Registered queries of the subpackage against their SQL, and their contracts' columns."""

import compare
import pytest
from tidemark.llm.queries import QUERIES, SQL

CONTRACT = {
    "op1": "doc_id n_shingles component_id",
    "op2": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op3": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op4": "doc_id held_out score predicted",
    "op5": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op7": "page_id url text n_chars",
    "op8": "doc_id piece start length ids_crc32 sequence_id offset",
    "op9": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op10": "doc_id held_out lang_pred score",
    "op11": "doc_id size text_crc32 law shard slot grown_shard",
    "op12": "item_id rank doc_id score",
    "op13": "vec_id component n deviation whitened explained identity_error",
}

SOURCE = {"op7": ("pages", "page_id"), "op12": ("benchmark", "item_id"), "op13": ("embeddings", "vec_id")}


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(name, spark, sf_dir):
    mine = compare.spark_bag(QUERIES[name](spark, sf_dir))
    theirs = compare.duck_bag(compare.connect(sf_dir), SQL[name])
    assert compare.difference(mine, theirs) is None
    assert mine[1]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(name, spark, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    wanted = CONTRACT.get(name.split("_")[0], "doc_id").split()
    assert set(wanted) <= set(df.columns)
    source, key = SOURCE.get(name.split("_")[0], ("documents", "doc_id"))
    rows = spark.read.parquet(f"{sf_dir}/{source}.parquet").count()
    assert df.select(key).distinct().count() == rows
