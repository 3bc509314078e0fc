"""The cube method keeps its sums, targets follow the rule, the mix keeps its bounds."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orderloom.llm import mixing
from orderloom.llm.mixing import flight, mix, mixed_rows


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=0, max_size=60), st.floats(0.01, 0.99), st.integers(0, 10**6))
def test_flight_keeps_sums(sizes, p, seed):
    size, pi = np.array(sizes, dtype=float), np.full(len(sizes), p)
    out = flight(pi, size, np.random.default_rng(seed), False)
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert out.sum() == pytest.approx(pi.sum(), abs=1e-6) and (out * size).sum() == pytest.approx((pi * size).sum(), abs=1e-4)
    landed = flight(pi, size, np.random.default_rng(seed), True)
    assert set(landed.tolist()) <= {0.0, 1.0} and abs(landed.sum() - pi.sum()) < 2


def test_flight_is_unbiased():
    size = np.array([5.0, 1, 9, 9, 2, 40, 3])
    mean = np.mean([flight(np.full(7, 0.3), size, np.random.default_rng(s), True) for s in range(4000)], axis=0)
    assert np.abs(mean - 0.3).max() < 0.04


def brute_targets(sizes):
    weight = dict(zip(sorted(sizes, key=lambda s: (s is None, (s or "").encode())), [5, 2, 1] * 99))
    target, full, total = {}, set(), 1.5 * sum(sizes.values())
    while True:
        rest = sum(w for s, w in weight.items() if s not in full)
        left = total - sum(2 * sizes[s] for s in full)
        target = {s: 2.0 * sizes[s] if s in full else left * w / rest for s, w in weight.items()}
        over = {s for s in weight if s not in full and target[s] >= 2 * sizes[s]}
        if not over:
            return target
        full |= over


def rows_of(text_of):
    sources = ["b", "a", None, "é", "Z", "", "one"]
    rows = [(i, text_of(i, 1 + i % 37), "en", sources[min(i % 11, 6)]) for i in range(900)]
    return rows + [(None, None, None, None), (1, None, "en", "a"), (2, "", "en", "empty"), (3, "x y", "en", "a"), (3, "x y", "en", "a"), (None, "p q", None, "b")]


def test_mix(docs_of, text_of, monkeypatch):
    rows = rows_of(text_of)
    docs = docs_of(rows).selectExpr("*", "n_chars AS size", "lang AS row_key", "n_chars AS copies")
    out = mix(docs, chunk=64).collect()
    assert sorted((r.doc_id, r.source, r["size"]) for r in out if r.doc_id is not None and r.source) == sorted(
        (i, s, len((t or "").split())) for i, t, _, s in rows if i is not None and s)
    assert len(out) == len(rows)
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    target = brute_targets(sizes)
    for s, size in sizes.items():
        mine = [r for r in out if r.source == s]
        assert {r.source_size for r in mine} == {size}
        assert mine[0].target == pytest.approx(target[s]) and abs(sum(r.taken for r in mine) - target[s]) <= 40
    assert all(r.taken in (0, r["size"], 2 * r["size"]) and r.taken == r.copies * r["size"] for r in out)
    again = mix(docs.repartition(7), chunk=64).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_mixed_rows(docs_of, text_of):
    docs = docs_of(rows_of(text_of))
    want = {}
    for r in mix(docs).collect():
        want[r.doc_id, r["size"]] = want.get((r.doc_id, r["size"]), 0) + r.copies
    rows = mixed_rows(docs)
    assert rows.columns == docs.columns
    got = {}
    for r in rows.collect():
        key = r.doc_id, len((r.text or "").split())
        got[key] = got.get(key, 0) + 1
    assert got == {k: n for k, n in want.items() if n}


def test_empty_tables(docs_of):
    assert mix(docs_of([])).collect() == []
    only_null = mix(docs_of([(1, None), (2, "")])).collect()
    assert [(r.target, r.taken) for r in only_null] == [(0.0, 0), (0.0, 0)]


def test_constants():
    assert mixing.WEIGHTS == (5, 2, 1) and mixing.SHARE == 1.5 and mixing.CAP == 2.0
