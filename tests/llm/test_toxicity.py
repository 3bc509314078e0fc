"""Exact neighbours against brute force, learning on planted words, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import toxicity as tox


def index_of(rng, n, words):
    vectors = (rng.random((n, words)) * (rng.random((n, words)) < 0.2)).astype(np.float32)
    vectors[:3] = 0
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors = np.where(norm > 0, vectors / np.maximum(norm, 1e-9), 0).astype(np.float32)
    total = rng.integers(1, 5, n)
    return tox.BlockMaxIndex(np.arange(words, dtype=np.uint64), np.ones(words), vectors, total, rng.integers(0, total + 1), [[int(i)] for i in range(n)])


def test_block_max_search_is_exact():
    rng = np.random.default_rng(5)
    index = index_of(rng, 700, 12)
    for _ in range(200):
        where = np.sort(rng.choice(12, rng.integers(1, 6), replace=False))
        weight = rng.random(len(where))
        weight /= np.linalg.norm(weight)
        ids, cos = index.nearest(where, weight, 25)
        every = index.vectors[:, where] @ weight
        least = np.sort(every[every > 0])[::-1][:25].min(initial=9)
        want = set(np.flatnonzero((every > 0) & (every >= least - 1e-9)).tolist())
        assert set(ids.tolist()) == want
        assert (np.diff(cos) <= 1e-6).all()


def planted(text_of, n=600):
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        words = text_of(i, 40, 900).split()
        if toxic:
            words[5] = "Grumpf," if i % 8 else f"blarg{i}"
            words[20] = "snarl"
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_learns_and_holds_out(spark, docs_of, text_of):
    rows, labels = planted(text_of)
    odd = [(None, None), (9000, ""), (9001, "grumpf"), (9002, "nice words only " * 3000), (4, rows[4][1])]
    docs = docs_of(rows + odd).selectExpr("*", "n_chars AS toxicity_score", "n_chars AS label", "n_chars AS toxic")
    table = spark.createDataFrame([*labels, (None, 1, 1), (4, 0, None)], "doc_id long, quality int, toxic int")
    out = tox.toxicity(docs, table, ["doc_id", "text"]).collect()
    assert len(out) == len(rows) + len(odd)
    for r in out:
        if r.doc_id is not None and r.doc_id < 9000:
            assert (r.toxicity_score >= 0.5) == (r.doc_id % 4 == 0), r
        assert 0 <= r.toxicity_score <= 1
    found = {r.doc_id: r for r in out}
    assert found[9001].toxicity_score >= 0.5 and found[9001].toxicity_evidence
    assert found[9002].toxicity_score < 0.5 and found[9000].toxicity_score == found[None].toxicity_score < 0.5


def test_held_out_labels_have_no_effect(spark, docs_of, text_of):
    import zlib

    rows, labels = planted(text_of, 200)
    flipped = [(i, q, 1 - t) if zlib.crc32(str(i).encode()) % 5 == 0 else (i, q, t) for i, q, t in labels]
    schema = "doc_id long, quality int, toxic int"
    a, b = (sorted((r.doc_id, r.toxicity_score) for r in tox.toxicity(docs_of(rows), spark.createDataFrame(x, schema)).collect()) for x in (labels, flipped))
    assert a == b


@pytest.mark.parametrize("which", ["none", "one class"])
def test_without_two_classes(spark, docs_of, text_of, which):
    rows, labels = planted(text_of, 30)
    labels = [(i, q, 0) for i, q, _ in labels] if which == "one class" else labels
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = tox.toxicity(docs_of(rows), table.filter("false") if which == "none" else table).collect()
    assert len(out) == 30 and all(r.toxicity_score < 0.5 for r in out)


def test_empty_documents(spark, docs_of):
    table = spark.createDataFrame([(1, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert tox.toxicity(docs_of([]), table).collect() == []


def test_an_insult_seen_once(spark, docs_of, text_of):
    rows, labels = planted(text_of, 200)
    once = next(i for i, _, t in labels if t and i % 5 == 2)
    rows = [(i, text_of(i, 40, 900).replace(" ", " zorgblat ", 1) if i == once else t) for i, t in rows]
    plain = " ".join(f"unheard{i}" for i in "abcdefghij")
    docs = docs_of(rows + [(9000, f"{plain} zorgblat"), (9001, plain), (9002, "zorgblat")])
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").filter(~tox.held_out() | (F.col("doc_id") == once))
    found = {r.doc_id: r for r in tox.score(docs, tox.fit(docs, table.withColumnRenamed("toxic", "label"))).collect()}
    assert found[9000].toxicity_score >= 0.5 > found[9001].toxicity_score and found[9002].toxicity_score >= 0.5
    assert found[9000].toxicity_evidence == found[9002].toxicity_evidence == [once]


def test_few_labels(spark):
    from oracle import TESTDATA
    from orderloom.llm.queries import QUERIES

    labels = spark.read.parquet(f"{TESTDATA}/sf0.001/labels.parquet").select("doc_id", "toxic")
    out = QUERIES["op5_toxicity"](spark, f"{TESTDATA}/sf0.001").join(labels, "doc_id").collect()
    assert sum(r.toxic for r in out) == 11
    assert [r.doc_id for r in out if r.predicted != r.toxic] == []


def test_votes_are_distance_weighted_shares():
    rng = np.random.default_rng(8)
    index = index_of(rng, 300, 12)
    base = index.positive.sum() / index.total.sum()
    for _ in range(50):
        where = np.sort(rng.choice(12, 3, replace=False))
        weight = rng.random(3)
        weight /= np.linalg.norm(weight)
        cos = index.vectors[:, where] @ weight
        near = np.flatnonzero((cos > 0) & (cos >= np.sort(cos[cos > 0])[::-1][: tox.K].min(initial=9) - 1e-9))
        w = 1 / (1 - np.minimum(cos[near], 1) + tox.SOFTEN)
        want = ((w * index.positive[near]).sum() + base) / ((w * index.total[near]).sum() + 1)
        share, ids, _ = index.votes(where, weight)
        assert share == pytest.approx(want, abs=1e-6) and set(ids.tolist()) == set(near.tolist())
        out = int(near[0])
        left = ((w * index.positive[near]).sum() - w[0] * 1 + base) / ((w * index.total[near]).sum() - w[0] + 1)
        assert index.votes(where, weight, out, 1)[0] == pytest.approx(left, abs=1e-6)


def test_vectors_weigh_terms_by_count_idf_and_relevance():
    import pyarrow as pa
    from collections import Counter

    text = "Snarl snarl grumpfly, quiet grumpfly! x"
    terms = Counter(["snarl"] * 2 + ["grumpfly"] * 2 + ["quiet", "x"])
    _, _, hashes = tox._terms(pa.array(["snarl grumpfly quiet x"]))
    words = np.sort(hashes)  # and the beginning of grumpfly
    gain = np.arange(1, len(words) + 1, dtype=float)
    where, weight = next(tox._vectors(pa.array([text]), words, gain))
    assert where.tolist() == list(range(len(words)))
    one = {w: tox._terms(pa.array([w]))[2] for w in terms}
    times = np.zeros(len(words))
    for w, n in terms.items():
        times[np.searchsorted(words, one[w])] += n
    want = (1 + np.log(times)) * gain
    assert np.allclose(weight, want / np.linalg.norm(want))


def test_relevance_is_nothing_where_chance_says_the_same():
    n, pos = np.array([100.0, 100, 100, 1, 1, 0]), np.array([10.0, 14, 60, 1, 0, 0])
    got = tox._relevance(n, pos, 1000, 100)
    assert got[0] == got[1] == got[4] == got[5] == 0 and got[2] > 100 and 0 < got[3] < 10


def test_witnesses_are_no_near_copies(spark, text_of):
    base = text_of(1, 80).split()
    near, far = base[:75] + text_of(2, 5).split(), base[:30] + text_of(3, 50).split()
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far)), (4, " ".join(base).upper()), (5, ""), (6, None), (7, "two words"), (8, "Two Words")]
    kept = [r.row for r in tox._fresh(spark.createDataFrame(rows, "row long, text string")).collect()]
    assert sorted(kept) == [1, 3, 5, 6, 7]
