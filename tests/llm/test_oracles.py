"""The queries of this package against their SQL, and the contract of each."""

import pytest

import corpus_pipeline
from oracle import TESTDATA, compare, duck
from orderloom.llm.queries import QUERIES, SQL

SF = f"{TESTDATA}/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    ok, text = compare(spark, QUERIES[name], SQL[name], SF, duck(SF))
    assert ok, text


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "benchmark_decontamination", "mixing", "sharding"]


CONTRACT = {
    "op2_quality_rules": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint",
                          "base_failed": "boolean", "kept": "boolean"},
    "op3_ngram_jaccard_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op4_sharding": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op5_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op7_warc": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
    "op8_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op11_centroid_clustering": {"vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint", "inertia": "bigint", "centroid_sha256": "string"},
    "op12_conversation_repair": {"conv_id": "bigint", "gaps": "bigint", "blank": "bigint", "duplicate": "bigint", "truncated": "bigint", "illegal": "bigint", "cost": "bigint",
                                 "audit": "string", "repaired_sha256": "string"},
    "op13_exact_top_k": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op9_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_contract_columns(spark, name):
    got = dict(QUERIES[name](spark, SF).dtypes)
    assert {c: got.get(c) for c in CONTRACT[name]} == CONTRACT[name]
