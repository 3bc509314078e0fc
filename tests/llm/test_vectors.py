"""Centroid clustering and top-k search against brute force, on plain, odd and empty tables."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import top_k as t
from orderloom.llm.centroids import Centroids, clusters
from orderloom.llm.queries import QUERIES
from orderloom.llm.top_k import best, top_k

SCHEMA = "vec_id long, embedding array<float>"


def floats(r, n, spread=0.3):
    return [float(np.float32(r.gauss(0, spread))) for _ in range(n)]


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def whole(v):
    return [math.floor(64 * x) for x in v]


def lloyd(rows, k, rounds, width):
    kept = [(i, whole(v)) for i, v in rows if usable(v) and len(v) == width]
    name = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [v for _, v in sorted(kept, key=name)[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        of = {}
        for _, v in kept:
            of.setdefault(nearest(v)[1], []).append(v)
        for n, vs in of.items():
            centroids[n] = [sum(col) // len(vs) for col in zip(*vs)]
    out = [(i, nearest(v)[1], nearest(v)[0]) for i, v in kept]
    total = sum(d for _, _, d in out)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, sum(x for _, y, x in out if y == c), total, sha[c]) for i, c, d in out), key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def odd_rows(seed=1, n=150):
    r = random.Random(seed)
    rows = [(i, floats(r, 8)) for i in range(n)]
    rows += rows[:30]  # repeated rows
    rows += [(n + i, rows[i][1]) for i in range(20)]  # equal vectors
    rows += [(300, None), (301, []), (302, [None] * 8), (303, [float("nan")] * 8), (304, [float("inf"), *floats(r, 7)]), (305, floats(r, 7)), (306, floats(r, 9)),
             (None, floats(r, 8)), (None, rows[0][1]), (320, [0.0] * 8), (340, [0.0] * 8), (-40, floats(r, 8, 50.0))]
    return rows


@pytest.mark.parametrize("seed", range(6))
def test_outward_search_is_exact(seed):
    r = np.random.default_rng(seed)
    x, c = r.integers(-3, 4, (400, 5)), r.integers(-3, 4, (16, 5))
    if seed % 2:
        x, c = x * 3_000_000 + r.integers(-2, 3, x.shape), c * 3_000_000
    distance = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
    who, found = Centroids(c).nearest(x)
    assert (who == distance.argmin(axis=1)).all() and (found == distance.min(axis=1)).all()


def test_clusters_equal_plain_rounds(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("cluster", F.lit("x")).withColumn("v", F.lit(1)).repartition(4)
    assert result(clusters(df, k=7, rounds=3, width=8)) == lloyd(rows, 7, 3, 8)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_clusters_of_few_vectors(spark, n):
    rows = [(i, [0.5 * i, -1.0]) for i in range(n)]
    df = clusters(spark.createDataFrame(rows, SCHEMA), k=4, rounds=2, width=2)
    assert result(df) == lloyd(rows, 4, 2, 2)
    assert dict(df.dtypes) == {"vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint", "inertia": "bigint", "centroid_sha256": "string"}


def plain_top(rows, k, asks=lambda i: i is not None and i % 20 == 0):
    kept = [(i, whole(v)) for i, v in rows if usable(v)]
    out = []
    for at, (i, v) in enumerate(kept):
        if asks(i):
            scores = [(-sum(a * b for a, b in zip(v, w)), j is None, j or 0) for o, (j, w) in enumerate(kept) if o != at]
            out += [(i, n, None if null else j, -s) for n, (s, null, j) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk, group", [(8192, 2048), (17, 3)])
def test_top_k_equals_all_pairs(spark, monkeypatch, chunk, group):
    monkeypatch.setattr(t, "CHUNK", chunk)
    monkeypatch.setattr(t, "GROUP", group)
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("row", F.lit("x")).withColumn("score", F.lit(1)).withColumn("id", F.lit(2)).repartition(3)
    assert result(top_k(df, F.col("vec_id") % 20 == 0, k=5)) == plain_top(rows, 5)


@pytest.mark.parametrize("rows", [[], [(0, [1.0])], [(1, [1.0]), (2, [2.0])], [(0, []), (20, None)], [(0, [1.0, 2.0]), (20, []), (40, [3.0])]])
def test_top_k_of_few_vectors(spark, rows):
    df = top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0)
    assert result(df) == plain_top(rows, 20)
    assert dict(df.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}


@pytest.mark.parametrize("seed, high", [(1, 3), (2, 60), (3, 2000), (4, 30_000_000), (5, 2**25)])
def test_bounds_lose_no_pair(seed, high):
    r = np.random.default_rng(seed)
    q, c = r.integers(-high, high + 1, (40, 30)), r.integers(-high, high + 1, (40, 1500))
    if seed == 1:
        c[:, 100:400] = c[:, :1]  # ties
    own = np.where(np.arange(30) % 2, np.arange(30) * 7, -1)
    c[:, own[own >= 0]] = q[:, own >= 0]
    at_q, at_c, score = best(q, c, own, 20)
    exact = q.T.astype(object) @ c.astype(object)
    found = {}
    for a, b, s in zip(at_q, at_c, score):
        assert exact[a, b] == s and own[a] != b
        found.setdefault(a, []).append((-s, b))
    for a in range(30):
        others = sorted((-s, b) for b, s in enumerate(exact[a]) if b != own[a])[:20]
        assert sorted(found[a])[:20] == others


def test_bounds_cut_most_of_the_work():
    r = np.random.default_rng(0)
    q, c = (np.floor(64 * r.normal(0, 0.125, (64, n))).astype(int) for n in (50, 8000))
    at_q, _, _ = best(q, c, np.full(50, -1), 20)
    assert len(at_q) < 0.1 * 50 * 8000


def test_contract_columns(spark):
    sf = "/root/testdata/sf0.001"
    assert QUERIES["op11_centroid_clustering"](spark, sf).count() == 500
    assert QUERIES["op13_exact_top_k"](spark, sf).count() == 25 * 20
