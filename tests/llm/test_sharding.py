"""Jump hashing against the published loop; gapless slots; few moves."""

import zlib

import numpy as np

from orderloom.llm.sharding import jump, shards


def published(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2**31 / ((key >> 33) + 1)))
    return b


def test_jump():
    keys = np.random.default_rng(3).integers(0, 2**64, 3000, dtype=np.uint64)
    for n in (1, 2, 8, 9, 1000):
        assert jump(keys, n).tolist() == [published(int(k), n) for k in keys]
    assert len(jump(keys[:0], 8)) == 0


def test_shards(docs_of, text_of):
    rows = [(i, text_of(i, 1 + i % 9)) for i in range(3000)] + [(None, None), (None, "x"), (None, "é"), (5, text_of(5, 6)), (5, "other"), (6, "")]
    docs = docs_of(rows).selectExpr("*", "n_chars AS size", "source AS law")
    out = shards(docs, docs.columns)
    assert set(docs.columns) <= set(out.columns) and len(set(out.columns)) == len(out.columns)
    got = out.collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == sorted((str(i), str(t)) for i, t in rows)
    for r in got:
        raw = (r.text or "").encode()
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert r.grown_shard in (r.shard, 8)
    for s in range(8):
        slots = sorted((r.slot, r.doc_id is not None, r.doc_id or 0) for r in got if r.shard == s)
        assert [x[0] for x in slots] == list(range(len(slots))) and [x[1:] for x in slots] == sorted(x[1:] for x in slots)
        assert 300 < len(slots) < 450
    assert 0.08 < sum(r.grown_shard == 8 for r in got) / len(got) < 0.15
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, set()).add(r.shard)
    assert all(len(s) == 1 for s in by_id.values())


def test_empty(docs_of):
    assert shards(docs_of([])).collect() == []
