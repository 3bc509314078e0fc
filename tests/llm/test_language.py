"""The forward sums against all segmentations, expectation against finite differences, accuracy on held-out rows."""

import itertools
import math
import random

import numpy as np
import pytest

from orderloom.llm import kernel
from orderloom.llm import language as lang
from orderloom.llm.tables import table
from oracle import TESTDATA

NAMES = [b"a", b"b", b"ab", b" a", b" ", b"ba", b"aba", "é".encode()]


def brute(word, p, g):
    """The sum over all ways to cut a word into pieces or single bytes."""
    total = 0.0
    for cuts in itertools.product((0, 1), repeat=len(word) - 1):
        parts, start = [], 0
        for i, c in enumerate(cuts, 1):
            if c:
                parts.append(word[start:i])
                start = i
        parts.append(word[start:])
        chances = [[math.log(0)] if False else [p[NAMES.index(x), g]] * (x in NAMES) if x in NAMES else [] for x in parts]
        value = 1.0
        for x, c in zip(parts, chances):
            value *= sum(c) + (lang.BYTE_PROBABILITY if len(x) == 1 else 0.0)
        total += value
    return total


def spans(words):
    ends = np.cumsum([len(w) for w in words])
    lengths = np.array([len(w) for w in words])
    return np.frombuffer(b"".join(words), dtype=np.uint8), ends - lengths, lengths


def test_forward_is_the_sum_over_segmentations():
    rng = np.random.default_rng(1)
    p = rng.random((len(NAMES), 2))
    words = [b" abab", b" a", b" ", b" xyz", " aéb".encode(), b" bbbaabab", b" ababababab"]
    got = lang.log_likelihoods(lang.Lattice(NAMES), p, *spans(words))
    want = [[math.log(brute(w, p, g)) for g in range(2)] for w in words]
    assert np.allclose(got, want, rtol=1e-9)


def test_expected_counts_are_the_gradient():
    rng = np.random.default_rng(2)
    p, words = rng.random((len(NAMES), 2)), [b" abab", b" ba", b" aba"]
    owner, count = np.array([0, 1, 0]), np.array([2.0, 3.0, 1.0])
    got = lang.expected_counts(lang.Lattice(NAMES), p, *spans(words), owner, count)
    for j, g in itertools.product(range(len(NAMES)), range(2)):
        q = p.copy()
        q[j, g] *= 1 + 1e-6
        a, b = (lang.log_likelihoods(lang.Lattice(NAMES), x, *spans(words))[np.arange(3), owner] @ count for x in (p, q))
        assert got[j, g] == pytest.approx((b - a) / 1e-6, abs=1e-3)


def log_sums(word, p):
    """The forward sums in logarithms, one place after the other."""
    out = np.full((len(word) + 1, p.shape[1]), -np.inf)
    out[0] = 0
    for end in range(1, len(word) + 1):
        out[end] = out[end - 1] + math.log(lang.BYTE_PROBABILITY)
        for i, name in enumerate(NAMES):
            if word[:end].endswith(name):
                out[end] = np.logaddexp(out[end], out[end - len(name)] + np.log(p[i]))
    return out[-1]


@pytest.mark.parametrize("block", [7, 64, 1 << 16])
def test_words_of_any_length(monkeypatch, block):
    monkeypatch.setattr(lang, "BLOCK_BYTES", block)
    r = random.Random(block)
    p = np.random.default_rng(block).random((len(NAMES), 3)) * 0.3
    words = [(" " + "".join(r.choices(["a", "b", "aba", "é", "x", "日本"], k=k))).encode() for k in (3, 25, 40, 90, 400, 1500)]
    got = lang.log_likelihoods(lang.Lattice(NAMES), p, *spans(words))
    assert np.allclose(got, [log_sums(w, p) for w in words], rtol=1e-9)


def test_long_words_do_not_under_or_overflow():
    for chance in (1e-9, 0.9):
        p = np.full((len(NAMES), 1), chance)
        buf, starts, ends, doc = lang._spans(kernel.Texts(__import__("pyarrow").array(["ab" * 5000 + " x " + "é" * 3000])))
        assert (ends - starts).tolist() == [10001, 2, 6001]
        assert np.isfinite(lang.log_likelihoods(lang.Lattice(NAMES), p, buf, starts, ends - starts)).all()


def test_what_is_learnt_from_is_cut_between_letters():
    buf, *where = lang._spans(kernel.Texts(__import__("pyarrow").array(["日本語" * 50 + " ok", "é" * 100])))
    starts, ends, doc = lang._cut(buf, *where)
    assert (ends - starts).max() <= lang.MAX_BYTES and (ends - starts).sum() == 451 + 3 + 201 and sorted(set(doc.tolist())) == [0, 1]
    for a, b in zip(starts, ends):
        buf[a:b].tobytes().decode()


def test_held_out_accuracy(spark):
    docs = table(spark, f"{TESTDATA}/sf0.01", "documents")
    out = lang.language(docs).join(docs.select("doc_id", "lang"), "doc_id").withColumn("held", lang.held_out())
    rows = out.filter("held").collect()
    assert len(rows) > 150 and sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)


def test_odd_rows(docs_of):
    r = random.Random(3)
    en, de = "the quick house was under water and with them".split(), "der schnelle hund war nicht unter wasser und ihnen".split()
    rows = [(i, " ".join(r.choices(en if i % 2 else de, k=12)), "en" if i % 2 else "de") for i in range(200)]
    odd = [(None, None, "en"), (1000, "", "en"), (1001, "123 !? 4", "de"), (1002, "THE WATER", None), (1003, "schnelle " * 9000, ""), (None, "und nicht", "de"), (7, rows[7][1], "en")]
    docs = docs_of(rows + odd).selectExpr("*", "lang AS lang_pred", "n_chars AS score")
    out = lang.language(docs).collect()
    assert len(out) == len(rows) + len(odd)
    found = {r.doc_id: r for r in out if r.doc_id is not None}
    assert all(found[i].lang_pred == g for i, _, g in rows)
    assert (found[1000].lang_pred, found[1001].lang_pred, found[1002].lang_pred, found[1003].lang_pred) == ("und", "und", "en", "de")
    assert {r.lang_pred for r in out if r.doc_id is None} == {"und", "de"} and all(0 <= r.score <= 1 for r in out)
    assert lang.language(docs_of([])).collect() == []
    assert {r.lang_pred for r in lang.language(docs_of([(1, "the water", None)])).collect()} == {"und"}
