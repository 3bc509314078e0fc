"""Stupid-backoff scores of documents, each by the n-gram counts of all other documents.

The score of a word is c(its n-gram) / c(the n - 1 words before it) for the longest n-gram, up to `order` words, that other documents hold;
each order backed off costs a factor `alpha`; a word that no other document holds counts as less than one occurrence. A document's own
n-grams are left out of the counts, or each text would confirm itself.

Count tables are partitioned by the n-grams' hash. Documents are dealt into blocks; a block joins each of its distinct n-grams once with the
tables (blocks.py) and sums the logarithms per document. Orders are counted one after the other: an n-gram can stand in another document
only if both n-grams of the order below that it consists of do, so the others, most of the long ones, are never sent.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm import blocks, kernel
from orderloom.llm.kernel import U
from orderloom.llm.tables import staging

ORDER = 3
ALPHA = 0.4


class _Block:
    """The words of a block, and order by order which n-grams stand how often in other documents."""

    def __init__(self, table: pa.Table):
        hashes, lengths = [np.zeros(0, dtype=U)], [np.zeros(0, dtype=np.int64)]
        for batch in kernel.table_slices(table, "text"):
            texts = kernel.Texts(batch.column("text"))
            hashes.append(texts.hashes())
            lengths.append(texts.n_words())
        self.hashes, self.lengths = np.concatenate(hashes), np.concatenate(lengths)
        self.doc = np.repeat(np.arange(len(self.lengths)), self.lengths)

    def wanted(self, n: int, below: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and places of the n-grams that may stand elsewhere; below: for each place the count elsewhere one order lower."""
        if n == 1:
            return kernel.mix(self.hashes), np.arange(len(self.hashes))
        value, at = kernel.grams(self.hashes, self.doc, n)
        keep = (below[at] > 0) & (below[at + 1] > 0)
        return value[keep], at[keep]

    def elsewhere(self, value: np.ndarray, at: np.ndarray, total: np.ndarray) -> np.ndarray:
        """For each place the count of the n-gram that begins there in other documents; total: of the distinct hashes, rising."""
        out = np.zeros(len(self.hashes), dtype=np.int64)
        if len(value):
            _, place = np.unique(value, return_inverse=True)
            own = kernel.mix(value + kernel.mix(self.doc[at].astype(U)))
            _, mine, often = np.unique(own, return_inverse=True, return_counts=True)
            out[at] = total[place] - often[mine]
        return out


def _levels(table: pa.Table, found: dict[int, np.ndarray], upto: int):
    """The block, counts elsewhere for orders 1 .. upto, and the wanted n-grams of the order after that."""
    block, levels = _Block(table), []
    for n in range(1, upto + 1):
        value, at = block.wanted(n, levels[-1] if levels else None)
        levels.append(block.elsewhere(value, at, found.get(n, np.zeros(0, dtype=np.int64))))
    return block, levels


def _score(table: pa.Table, found: dict[int, np.ndarray], order: int, alpha: float, words: int) -> dict[str, list]:
    block, levels = _levels(table, found, order)
    count, docs = len(block.hashes), len(block.lengths)
    others = np.maximum(1, words - block.lengths)[block.doc].astype(float)
    start = np.concatenate([[0], np.cumsum(block.lengths)[:-1]])[block.doc] if docs else np.zeros(0, dtype=np.int64)
    reach = np.minimum(order, np.arange(count) - start + 1)  # the longest n-gram that ends here
    used = np.zeros(count, dtype=np.int64)
    value = alpha ** reach / others
    for n in range(1, order + 1):
        begin = np.arange(count) - n + 1
        here = np.flatnonzero((begin >= start) & (levels[n - 1][np.maximum(begin, 0)] > 0))
        context = others[here] if n == 1 else levels[n - 2][begin[here]]
        value[here] = alpha ** (reach[here] - n) * levels[n - 1][begin[here]] / context
        used[here] = n
    out = {"n_words": block.lengths, "log_score": np.bincount(block.doc, weights=np.log(value), minlength=docs)}
    for n in range(order + 1):
        out[f"n_order_{n}"] = np.bincount(block.doc[used == n], minlength=docs)
    return out


def lm_scores(docs: DataFrame, *, order: int = ORDER, alpha: float = ALPHA, block_bytes: int = blocks.BLOCK_BYTES, bucket_keys: int = blocks.BUCKET_KEYS) -> DataFrame:
    """One row per document (doc_id, text): doc_id, n_words, log_score (natural logarithms, summed), mean_log_score (null without words), and
    n_order_0 .. n_order_<order>: words scored by an n-gram of that length; 0: words no other document holds.

    Null and empty texts have no words and a log_score of 0. Repeated rows are documents of their own, so they confirm each other. In a table
    of one document every word is unseen. Extra columns are not read.
    """
    stage = staging(docs.sparkSession)
    total, words = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)),
                            F.coalesce(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long")), F.lit(0))).first()
    n_blocks, n_buckets = blocks.block_count(total, block_bytes), max(1, -(-total // (6 * bucket_keys)))
    routed = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).alias("block"), "doc_id", "text")
    answers = None
    for n in range(1, order + 1):
        def request(block, table, found, n=n):
            state, levels = _levels(table, found, n - 1)
            keys, counts = np.unique(state.wanted(n, levels[-1] if levels else None)[0], return_counts=True)
            return blocks.ask(block, n, keys, counts, n_buckets, 8)

        answer = stage(blocks.answered(routed, answers, request, encode=lambda x: x))
        answers = answer if answers is None else answers.unionByName(answer)

    def use(table, found):
        out = _score(table, found, order, alpha, words)
        return pa.table([table.column("doc_id"), *(pa.array(v) for v in out.values())], names=["doc_id", *out])

    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_order_{n} long" for n in range(order + 1))
    scored = blocks.with_answers(routed, answers, use, f"doc_id {kind}, n_words long, log_score double, {counts}", np.int64)
    return scored.withColumn("mean_log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))
