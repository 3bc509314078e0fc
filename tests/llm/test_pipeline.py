"""The stages on a small planted corpus, each against what it must do to its input."""

import pytest

import corpus_pipeline
from oracle import TESTDATA


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory, docs_of, text_of):
    root = str(tmp_path_factory.mktemp("corpus"))
    items = [(i, text_of(9000 + i, 40)) for i in range(3)]
    rows = []
    for i in range(300):
        text = text_of(i, 60)
        if i % 10 == 0:
            text = text.replace(" ", " zorgh ", 3)
        elif i % 10 == 1:
            text = text_of(i - 10 if i > 10 else i, 60) if i % 20 == 1 else text
        elif i % 10 == 2:
            text += " " + items[i % 3][1]
        rows.append((i, text, "en", f"s{i % 4}"))
    rows += [(None, None, None, None), (1000, "", "en", None), (5, rows[5][1], "en", "s1")]
    docs_of(rows).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 10 == 0)) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def test_stages(spark, corpus):
    docs, columns = spark.read.parquet(f"{corpus}/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        columns = docs.columns
        out = stage(spark, docs, corpus)
        after = [(r.doc_id, r.text) for r in out.collect()]
        if name == "toxicity":
            assert not any(t and "zorgh" in t for _, t in after) and len(after) == len(before) - 30
        elif name == "ngram_jaccard_join":
            assert sorted(str(t) for _, t in after) == sorted({str(t) for _, t in before})
        elif name == "benchmark_decontamination":
            assert sorted(map(str, after)) == sorted(str(x) for x in before if x[0] is None or x[0] % 10 != 2)
        elif name == "mixing":
            assert set(after) <= set(before) and max(after.count(x) for x in set(after)) <= 2
        else:
            assert sorted(map(str, after)) == sorted(map(str, before))
            assert set(columns) < set(out.columns)
            break
        assert out.columns == columns
        docs = spark.createDataFrame(out.collect(), out.schema)


def test_run_equals_the_stages(spark, corpus):
    out = corpus_pipeline.run(spark, corpus)
    assert out.count() > 100 and {"shard", "slot"} <= set(out.columns)


def test_run_on_given_tables(spark):
    out = corpus_pipeline.run(spark, f"{TESTDATA}/sf0.001")
    slots = {}
    for r in out.collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
