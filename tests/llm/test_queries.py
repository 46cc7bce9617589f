"""The registered queries and the pipeline on the small tables."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from shillingflow.llm.queries import QUERIES, SQL

from ..compare import connect, normal

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    1: "doc_id n_shingles component_id kept", 2: "doc_id piece start length ids_crc32 sequence_id offset",
    3: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept", 4: "doc_id size text_crc32 law shard slot grown_shard",
    5: "doc_id start n_tokens ids_crc32", 6: "doc_id size source_size target taken", 7: "page_id host path rule verdict",
    8: "doc_id n_bytes n_removed n_spans kept_sha256", 9: "query_id rank vec_id score", 10: "conv_id turn role content chat position",
    11: "vec_id code error label_error codebooks_sha256", 12: "doc_id n_words n_hit n_items items_sha256 contaminated",
    13: "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
}


def test_one_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", QUERIES)
def test_columns(spark, key):
    assert set(COLUMNS[int(key[2:].split("_")[0])].split()) <= set(QUERIES[key](spark, FOLDER).columns)


@pytest.mark.parametrize("key", SQL)
def test_matches_sql(spark, key):
    df, rel = QUERIES[key](spark, FOLDER), connect(FOLDER).sql(SQL[key])
    assert normal(df.collect(), df.columns) == normal(rel.fetchall(), rel.columns)


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "repeated_passages", "mix_sources", "pack_sequences"]
