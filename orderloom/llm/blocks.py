"""Counts of hashed keys over all texts, brought back to the texts that hold them, without a row per occurrence.

Texts are dealt into blocks of a bounded size. A block asks for each of its distinct keys once; the keys are dealt by their
leading bits into buckets, where the counts of all blocks are summed, and the answers go back to the blocks in the order asked.
A key that stands in a third of all texts is one entry per block, so no bucket grows with the frequency of a key.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.kernel import U

BLOCK_BYTES = 6 << 20
BUCKET_KEYS = 1 << 20
SHORT = 2  # bytes of a key that are sent, and a few bits more


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    return docs.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()[0]


def block_count(total: int, block_bytes: int = BLOCK_BYTES) -> int:
    return max(1, -(-total // block_bytes))


def _split(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where sorted keys change from one bucket to the next: bucket b holds [b, b + 1) * 2**64 / buckets."""
    step = (1 << 64) // buckets
    return np.searchsorted(keys, np.array([b * step for b in range(1, buckets)], dtype=U))


def _planes(numbers: np.ndarray) -> bytes:
    """The numbers' bytes plane by plane: the leading bytes of sorted keys, and of small counts, then compress to nearly nothing."""
    return numbers.view(np.uint8).reshape(len(numbers), -1).T.tobytes()


def _numbers(raw: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(size, -1).T).view(kind).ravel()


def _short(part: np.ndarray, step: int) -> bytes:
    """The leading 26 bits of sorted numbers below `step`: the last 16 as they are, the rise of the first 10 as bits, a one for each number, a zero for each step up."""
    leading = part >> U(max(0, step.bit_length() - 26))
    bits = np.zeros(len(part) + 1024, dtype=np.uint8)
    bits[(leading >> U(16)).astype(np.int64) + np.arange(len(part))] = 1
    return leading.astype(np.uint16).tobytes() + np.packbits(bits).tobytes()


def _from_short(raw: bytes, n: int) -> np.ndarray:
    rise = np.flatnonzero(np.unpackbits(np.frombuffer(raw, dtype=np.uint8, offset=2 * n))) - np.arange(n)
    return rise.astype(np.uint32) << np.uint32(16) | np.frombuffer(raw, dtype=np.uint16, count=n)


def ask(block: int, order: int, keys: np.ndarray, counts: np.ndarray, buckets: int, width: int) -> pa.Table:
    """Requests for sorted distinct keys; width: 8 for all bytes of a key, or SHORT: only its leading 26 bits within the bucket are sent, so that one
    key in 32 to 64 of a full bucket shares the count of another; never is a count too small."""
    cuts = [0, *_split(keys, buckets).tolist(), len(keys)]
    step, bucket, sent, often = (1 << 64) // buckets, [], [], []
    for b, (start, stop) in enumerate(zip(cuts, cuts[1:])):
        if stop > start:
            part = keys[start:stop] - U(b * step)
            bucket.append(b)
            sent.append(_short(part, step) if width == SHORT else _planes(part))
            often.append(_planes(counts[start:stop].astype(np.uint32)))
    return pa.table([pa.array([block] * len(bucket), pa.int64()), pa.array([order] * len(bucket), pa.int32()), pa.array(bucket, pa.int32()),
                     pa.array(sent, pa.binary()), pa.array(often, pa.binary())], names=["block", "ord", "bucket", "keys", "counts"])


ASKED_SQL = "block long, ord int, bucket int, keys binary, counts binary"
ANSWERED_SQL = "block long, ord int, bucket int, counts binary"


def _answer(width: int, encode: Callable[[np.ndarray], np.ndarray]):
    def answer(table: pa.Table) -> pa.Table:
        often = [_numbers(x, np.uint32) for x in table.column("counts").to_pylist()]
        asked = [_from_short(x, len(n)) if width == SHORT else _numbers(x, U) for x, n in zip(table.column("keys").to_pylist(), often)]
        counts = np.concatenate(often)
        ends = np.cumsum([len(x) for x in asked])
        order = np.argsort(np.concatenate(asked), kind="stable")
        keys = np.concatenate(asked)[order]
        group = np.cumsum(np.diff(keys, prepend=keys[:1]) != 0)
        total = np.empty(len(keys), dtype=np.int64)
        total[order] = np.bincount(group, weights=counts[order]).astype(np.int64)[group]
        total = encode(total)
        parts = [_planes(total[e - len(x): e]) for x, e in zip(asked, ends)]
        return pa.table([table.column("block"), table.column("ord"), table.column("bucket"), pa.array(parts, pa.binary())],
                        names=["block", "ord", "bucket", "counts"])

    return answer


def _found(right: pa.Table, kind) -> dict[int, np.ndarray]:
    rows = sorted(zip(right.column("ord").to_pylist(), right.column("bucket").to_pylist(), right.column("counts").to_pylist()))
    return {o: np.concatenate([_numbers(c, kind) for k, _, c in rows if k == o]) for o in {r[0] for r in rows}}


def answered(routed: DataFrame, before: DataFrame | None, request, *, width: int = 8, encode=lambda x: x, kind=np.int64) -> DataFrame:
    """The counts, over all blocks, of the keys each block of `routed` (a column `block`) asks for.

    request(block, rows, found) gives a table of ask(), its keys distinct and rising per ord; found has what `before` answered, by ord.
    """
    def first(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return request(key[0].as_py(), table, {})

    def later(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        return request(key[0].as_py(), left, _found(right, kind))

    blocks = routed.groupBy("block")
    asked = blocks.applyInArrow(first, ASKED_SQL) if before is None else blocks.cogroup(before.groupBy("block")).applyInArrow(later, ASKED_SQL)
    return asked.groupBy("ord", "bucket").applyInArrow(_answer(width, encode), ANSWERED_SQL)


def with_answers(routed: DataFrame, answers: DataFrame, use, schema: str, kind) -> DataFrame:
    """use(block's rows, {ord: counts in the order asked}) for each block."""
    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        return use(left, _found(right, kind))

    return routed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(apply, schema)
