"""Stupid backoff against a direct reading of its definition."""

import math
import re
from collections import Counter

import pytest

from orderloom.llm.lm_score import lm_scores


def brute(rows, order, alpha):
    docs = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    grams = [[Counter(tuple(d[i:i + n]) for i in range(len(d) - n + 1)) for n in range(1, order + 1)] for d in docs]
    total = [sum((g[n] for g in grams), Counter()) for n in range(order)]
    words, out = sum(map(len, docs)), []
    for (doc_id, _), d, own in zip(rows, docs, grams):
        def other(g, own=own):
            return total[len(g) - 1][g] - own[len(g) - 1][g]
        score, used = 0.0, [0] * (order + 1)
        others = max(1, words - len(d))
        for i in range(len(d)):
            reach = min(order, i + 1)
            for n in range(reach, -1, -1):
                if n == 0:
                    score += math.log(alpha**reach / others)
                elif (c := other(tuple(d[i - n + 1:i + 1]))) > 0:
                    score += math.log(alpha ** (reach - n) * c / (others if n == 1 else other(tuple(d[i - n + 1:i]))))
                else:
                    continue
                used[n] += 1
                break
        out.append((doc_id, len(d), round(score, 6), *used))
    return sorted(out, key=str)


def check(docs_of, rows, order=3, **options):
    got = lm_scores(docs_of(rows), order=order, **options).collect()
    assert sorted(((r.doc_id, r.n_words, round(r.log_score, 6), *(r[f"n_order_{n}"] for n in range(order + 1))) for r in got), key=str) == brute(rows, order, 0.4)
    for r in got:
        assert r.mean_log_score == (pytest.approx(r.log_score / r.n_words) if r.n_words else None)


def rows_of(text_of):
    return [(i, text_of(i % 25, 40, 12 + i)) for i in range(40)] + [
        (None, None), (100, ""), (101, " \n"), (102, "w1 w2"), (102, "w1 w2"), (None, "w1 w2 w3"), (103, "é É é É é")]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_orders(docs_of, text_of, order):
    check(docs_of, rows_of(text_of), order)


def test_many_blocks_and_buckets(docs_of, text_of):
    check(docs_of, rows_of(text_of), block_bytes=300, bucket_keys=20)


def test_long_text_and_one_document(docs_of, text_of):
    check(docs_of, [(1, text_of(1, 30_000, 300)), (2, text_of(2, 500, 300))])
    check(docs_of, [(1, "a b a b")])


def test_empty_table(docs_of):
    assert lm_scores(docs_of([])).collect() == []
