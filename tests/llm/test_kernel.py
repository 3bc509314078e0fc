"""Words, hashes and windows against Python's own."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from orderloom.llm import blocks, kernel

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\t\n\r\x0b\x0cß ,Z", max_size=40)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_and_grams(texts):
    t = kernel.Texts(pa.array(texts, pa.string()))
    words = [re.findall(r"[^\x20\x09-\x0D]+", x or "") for x in texts]
    assert [t.buf[a:b].tobytes().decode() for a, b in zip(t.starts, t.ends)] == [w for d in words for w in d]
    assert t.n_words().tolist() == [len(d) for d in words]
    hashes = t.hashes()
    flat = [w for d in words for w in d]
    assert (hashes[:, None] == hashes[None, :]).tolist() == [[a == b for b in flat] for a in flat]
    value, at = kernel.grams(hashes, t.doc, 2)
    pairs = [p for d in words for p in zip(d, d[1:])]
    assert len(at) == len(pairs)
    assert (value[:, None] == value[None, :]).tolist() == [[a == b for b in pairs] for a in pairs]


def test_slices_keep_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array([None, "a" * 50, "", "b" * 500, "c", None])], names=["text"])
    got = [x for s in kernel.slices([batch], "text", 40) for x in s.column("text").to_pylist()]
    assert got == batch.column("text").to_pylist()


def test_requests_cover_all_keys():
    keys = np.unique(kernel.mix(np.arange(1, 5000, dtype=kernel.U)))
    for buckets in (1, 3, 64):
        asked = blocks.ask(0, 1, keys, np.ones(len(keys), dtype=np.int64), buckets, 8)
        step = (1 << 64) // buckets
        back = np.concatenate([blocks._numbers(k, kernel.U) + kernel.U(b * step) for b, k in zip(asked.column("bucket").to_pylist(), asked.column("keys").to_pylist())])
        assert (back == keys).all()
