"""Words, word n-grams and lines of a batch of texts, as NumPy arrays over one UTF-8 buffer.

Words are `[^\\x20\\x09-\\x0D]+`. Equality of words, n-grams and lines is decided on 64-bit hashes, polynomial over the
bytes and then scrambled; two different values of n are taken for equal with a chance near n * n / 2**65.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
BASE = 0x9E3779B97F4A7C15
SLICE_BYTES = 1 << 20
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers one to one (the public splitmix64 finaliser)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE_VALUE = mix(np.arange(1, 257, dtype=U) * U(BASE))
STEP = mix(np.arange(1, 33, dtype=U) * U(0xD1B54A32D192ED03)) | U(1)
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = -(-n // 65536) * 65536
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(size, U(base), dtype=U)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"], _POWERS["down"]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each byte span, equal for equal bytes wherever they stand."""
    if not len(starts):
        return np.zeros(0, dtype=U)
    up, down = _powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, dtype=U)
    np.cumsum(BYTE_VALUE[buf] * up[: len(buf)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


class Texts:
    """The words of a few texts: buf, and for each word starts, ends, doc (its text's place in the batch)."""

    def __init__(self, texts: pa.Array, lower: bool = False, separator: np.ndarray = SPACE):
        raw = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
        self.n = len(raw)
        self.buf = np.frombuffer(b"\n".join([*raw, b""]), dtype=np.uint8)
        if lower:
            self.buf = LOWER[self.buf]
        lengths = np.fromiter((len(t) + 1 for t in raw), dtype=np.int64, count=self.n)
        self.doc_ends = np.cumsum(lengths) if self.n else np.zeros(0, dtype=np.int64)
        inside = ~separator[self.buf]
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
        self.starts, self.ends = edge[0::2], edge[1::2]
        self.doc = np.searchsorted(self.doc_ends, self.starts, side="right")
        self.first = np.searchsorted(self.doc, np.arange(self.n + 1))

    def hashes(self) -> np.ndarray:
        return span_hashes(self.buf, self.starts, self.ends)

    def n_words(self) -> np.ndarray:
        return np.diff(self.first)


def grams(hashes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word windows that lie within one text, and the place of each window's first word."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=U), np.zeros(0, dtype=np.int64)
    at = np.flatnonzero(doc[:count] == doc[n - 1:])
    value = np.zeros(count, dtype=U)
    for k in range(n):
        value += hashes[k: k + count] * STEP[k]
    return mix(value[at]), at


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `limit` bytes of text, so that the arrays over a buffer stay small."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        cuts = [0, *(np.flatnonzero(np.diff(size // limit)) + 1).tolist(), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            if stop > start:
                yield batch.slice(start, stop - start)


def table_slices(table: pa.Table, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    return slices(table.to_batches(), column, limit)


def packed(texts: pa.Array) -> pa.Array:
    """Each text's bytes by zstd, after their number; null stays null. Well under the size that Spark's shuffle writes them in."""
    codec = pa.Codec("zstd", compression_level=1)
    raw = texts.cast(pa.binary()).to_pylist()
    return pa.array([None if t is None else len(t).to_bytes(8, "little") + codec.compress(t, asbytes=True) for t in raw], pa.binary())


def unpacked(texts: pa.Array) -> pa.Array:
    """The bytes that packed() was given."""
    codec = pa.Codec("zstd")
    raw = [None if t is None else codec.decompress(t[8:], int.from_bytes(t[:8], "little"), asbytes=True) for t in texts.to_pylist()]
    return pa.array(raw, pa.binary())
