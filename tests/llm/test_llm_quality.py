"""Counts against brute force; learnt lists on planted rules."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from orderloom.llm import quality as q

WORD = r"[^\x20\x09-\x0D]+"


def brute(text):
    text = text or ""
    w = re.findall(WORD, text)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    often = Counter(windows)
    covered = {j for i, g in enumerate(windows) if often[g] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\r\t#|", max_size=120)), max_size=5))
def test_counts(texts):
    got = q.measure(pa.array(texts, pa.string()))
    rows = list(zip(*(got[c].tolist() for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))))
    assert rows == [brute(t) for t in texts]


def test_long_and_repeated(text_of):
    texts = [text_of(1, 30_000, 50), "a b c d e f g h " * 500, "\n".join(["same line"] * 50), None, ""]
    got = q.measure(pa.array(texts))
    rows = list(zip(*(got[c].tolist() for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))))
    assert rows == [brute(t) for t in texts]


def test_learns_planted_conjunctions():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.8) & (x[:, 1] < 0.5)) | (x[:, 2] > 0.95)
    rules = q.learn(x, y, ["symbol_share", "upper_share", "digit_share"])
    hit = np.zeros(len(x), dtype=bool)
    for rule in rules:
        hit |= q._covers(rule, x, ["symbol_share", "upper_share", "digit_share"])
    assert 1 <= len(rules) <= 4 and (hit == y).mean() > 0.98


def test_no_rule_from_noise():
    rng = np.random.default_rng(2)
    assert q.learn(rng.random((500, 2)), rng.random(500) < 0.2, ["symbol_share", "upper_share"]) == []


def test_query_on_nulls_ties_and_clashes(spark, docs_of, text_of):
    good = [(i, text_of(i, 60)) for i in range(120)]
    bad = [(1000 + i, " ".join(w + "###" for w in text_of(5000 + i, 60).split())) for i in range(60)]
    odd = [(None, None), (None, text_of(1, 60)), (2000, ""), (2001, "few words"), (2002, "a b c d e f g h i j " * 40), (3, text_of(3, 60))]
    docs = docs_of(good + bad + odd).selectExpr("*", "n_chars AS rule", "n_chars AS n_words", "lang AS label")
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(None, 0, 0), (1, None, 1), (7, 1, 1)], "doc_id long, quality int, toxic int")
    out = {(r.doc_id, r.n_words): r for r in q.quality(docs, labels).collect()}
    assert all(out[i, 60].kept for i, _ in good) and not any(out[i, 60].kept or out[i, 60].base_failed for i, _ in bad)
    assert out[None, 60].kept and not out[None, 0].kept and out[2002, 400].base_failed and out[2001, 2].base_failed
    empty = q.quality(docs_of([]), labels).collect()
    assert empty == []
    assert q.quality(docs_of(good[:3]), labels.filter("false")).filter("kept").count() == 3
