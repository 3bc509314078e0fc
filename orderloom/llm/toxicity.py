"""Toxicity by nearest labelled examples: exact TF-IDF cosine over an inverted index, distance-weighted votes.

Terms are words and the beginnings of long words, since insults are inflected and compounded. Fit (once, on a documented bounded sample
of labelled rows): all terms of the sample, with a weight of how well their presence tells the label apart (chi-square, less for what
chance gives) and their document frequencies over all documents, the examples as vectors of these terms, and a logistic calibration
of the votes, learnt leaving each example out of the index and of the terms' weights. Score: each whole text becomes such a vector;
its K nearest distinct example vectors (ties of the last included) vote with weight 1 / (1 - cosine + SOFTEN) for each example they
stand for. A text with none of the terms is at cosine 0 from everything; its votes are those of the examples that have none either.

The index is inverted and block-max: a term's postings fall into runs, one for each block of BLOCK example vectors that holds the term, and each run
knows its largest weight. A query adds up the maxima of its heaviest terms for each block, and how long what is left of it is, which bounds
the cosine of all vectors of the block. Blocks are looked into by falling bound, until the next bound is below the K-th best cosine
found: the neighbours are exact. Vectors that share their heaviest term are put into neighbouring blocks. The index is broadcast; its size is bounded by the terms of MAX_EXAMPLES
texts of EXAMPLE_CHARS characters, whatever the size of the corpus (5 MB over the given tables).

Weights are TF-IDF times how well a term's presence tells the label apart. Plain TF-IDF was measured and found wanting: of 126 toxic held-out documents its
nearest neighbours find 48, with these weights all 126 (4,000 examples, 1,200 documents; clean ones are left alone by both). Terms within two standard
deviations (rare ones: one) of what chance gives weigh nothing; no other term is left out.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm import kernel
from orderloom.llm.jaccard_join import _shingle_sets
from orderloom.llm.kernel import U
from orderloom.llm.tables import staging

MAX_EXAMPLES = 4_000  # labelled rows the index is fitted on, those with the smallest hash of doc_id
EXAMPLE_CHARS = 20_000  # longer texts are no examples
BLOCK = 64  # vectors
FIRST_BLOCKS = 4
SHINGLE_WORDS = 5
SIMILAR = (75, 100)
EXPECTED = 5
CHANCE = 10.0  # chi-square values well below this count by their square
REST = 0.05
K = 25
SOFTEN = 0.05
CACHE = 50_000
BEGINNINGS = (5,)  # bytes
SEPARATOR = np.array([not (b >= 0x80 or chr(b).isalnum()) for b in range(256)])


def _terms(column: pa.Array) -> tuple[kernel.Texts, np.ndarray, np.ndarray]:
    """The terms of each text, and the text each belongs to, text by text: its words and the beginnings of its longer words."""
    texts = kernel.Texts(column, lower=True, separator=SEPARATOR)
    starts, ends, doc, salt = [texts.starts], [texts.ends], [texts.doc], [np.zeros(len(texts.starts), dtype=U)]
    for length in BEGINNINGS:
        longer = np.flatnonzero(texts.ends - texts.starts > length)
        starts.append(texts.starts[longer])
        ends.append(texts.starts[longer] + length)
        doc.append(texts.doc[longer])
        salt.append(np.full(len(longer), kernel.STEP[length], dtype=U))
    hashes = kernel.span_hashes(texts.buf, np.concatenate(starts), np.concatenate(ends)) ^ np.concatenate(salt)
    doc = np.concatenate(doc)
    order = np.argsort(doc, kind="stable")
    return texts, doc[order], hashes[order]


def _in_words(words: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which hashes are among the sorted words, and the places of these among them."""
    if not len(words):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    unique, back = np.unique(hashes, return_inverse=True)
    at = np.minimum(np.searchsorted(words, unique), len(words) - 1)
    at = np.where(words[at] == unique, at, -1)[back]
    hit = np.flatnonzero(at >= 0)
    return hit, at[hit]


def _vectors(column: pa.Array, words: np.ndarray, gain: np.ndarray):
    """Per text the places of its terms and their weights, of length 1."""
    texts, doc, hashes = _terms(column)
    hit, at = _in_words(words, hashes)
    code, count = np.unique(doc[hit] * max(1, len(words)) + at, return_counts=True)
    doc, at = np.divmod(code, max(1, len(words)))
    cut = np.searchsorted(doc, np.arange(texts.n + 1))
    weights = (1 + np.log(count)) * gain[at]
    for d in range(texts.n):
        where, weight = at[cut[d]: cut[d + 1]], weights[cut[d]: cut[d + 1]]
        yield where, weight / np.sqrt((weight * weight).sum()) if len(where) else weight


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of the ranges, one range after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


@dataclass
class Sparse:
    """Vectors by row: the terms and weights of row i are those from cut[i] to cut[i + 1]."""

    cut: np.ndarray
    at: np.ndarray
    weight: np.ndarray

    def __len__(self) -> int:
        return len(self.cut) - 1


def _sparse(dense: np.ndarray) -> Sparse:
    row, at = np.nonzero(dense)
    return Sparse(np.searchsorted(row, np.arange(len(dense) + 1)), at.astype(np.int32), dense[row, at].astype(np.float32))


@dataclass
class BlockMaxIndex:
    """Distinct example vectors with how many examples, and how many of label 1, each stands for.

    Postings are sorted by term, then row. Those of one term in one block of BLOCK rows are a run with its largest weight."""

    words: np.ndarray
    idf: np.ndarray  # the weight of each word
    vectors: Sparse | np.ndarray | None  # or dense, one row each
    total: np.ndarray
    positive: np.ndarray
    evidence: list[list[int]]
    visited: int = 0  # blocks looked into, of all queries

    def __post_init__(self):
        rows = self.vectors if isinstance(self.vectors, Sparse) else _sparse(self.vectors)
        size = np.diff(rows.cut)
        self.empty = np.flatnonzero(size == 0)
        self.n_blocks = -(-len(rows) // BLOCK)
        row = np.repeat(np.arange(len(rows), dtype=np.int32), size)
        order = np.argsort(rows.at, kind="stable")
        self.ids, self.weights, term = row[order], rows.weight[order], rows.at[order].astype(np.int64)
        run = term * max(1, self.n_blocks) + self.ids // BLOCK
        first = np.flatnonzero(np.diff(run, prepend=-1))
        self.run_start = np.append(first, len(run)).astype(np.int32)
        self.run_block = (self.ids[first] // BLOCK).astype(np.int32)
        self.run_max = np.maximum.reduceat(self.weights, first) if len(first) else self.weights[:0]
        self.of_term = np.searchsorted(term[first], np.arange(len(self.words) + 1)).astype(np.int32)

    def nearest(self, where: np.ndarray, weight: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest vectors and all that tie with the last, and their cosines."""
        order = np.argsort(-weight, kind="stable")
        where, weight = where[order], weight[order]
        left = np.sqrt(np.maximum((weight * weight).sum() - np.cumsum(weight * weight), 0))
        runs = self.of_term[where + 1] - self.of_term[where]
        place, factor = _ranges(self.of_term[where], runs), np.repeat(weight, runs)
        block = self.run_block[place]
        # the heaviest terms by their maxima; what is left of the query adds no more than its length, as vectors have length 1
        head = int(np.searchsorted(-left, -REST)) + 1
        few = int(runs[:head].sum())
        bound = np.bincount(block[:few], weights=self.run_max[place[:few]] * factor[:few], minlength=self.n_blocks)
        bound += float(left[min(head, len(left)) - 1]) + 1e-5 if len(left) else 0
        bound[np.bincount(block, minlength=self.n_blocks) == 0] = 0
        by_bound = np.argsort(-bound, kind="stable")
        ids, cosines, least, step, done = np.zeros(0, dtype=np.int64), np.zeros(0), 0.0, FIRST_BLOCKS, 0
        while done < self.n_blocks:
            chosen = by_bound[done: done + step]
            chosen = chosen[(bound[chosen] > 0) & (bound[chosen] >= least)]
            if not len(chosen):
                break
            self.visited += len(chosen)
            slot = np.full(self.n_blocks, -1)
            slot[chosen] = np.arange(len(chosen))
            inside = np.flatnonzero(slot[block] >= 0)
            start = self.run_start[place[inside]]
            size = self.run_start[place[inside] + 1] - start
            posting = _ranges(start, size)
            row = self.ids[posting]
            score = np.bincount(slot[row // BLOCK] * BLOCK + row % BLOCK, weights=self.weights[posting] * np.repeat(factor[inside], size), minlength=len(chosen) * BLOCK)
            some = np.flatnonzero(score > 0)
            ids, cosines = np.append(ids, chosen[some // BLOCK] * BLOCK + some % BLOCK), np.append(cosines, score[some])
            if len(cosines) >= k:
                least = np.partition(cosines, len(cosines) - k)[len(cosines) - k] - 1e-9
            done, step = done + step, step * 4
        keep = cosines >= least
        order = np.lexsort((ids[keep], -np.round(cosines[keep], 9)))
        return ids[keep][order], cosines[keep][order]

    def votes(self, where: np.ndarray, weight: np.ndarray, out: int = -1, label: int = 0) -> tuple[float, np.ndarray, np.ndarray]:
        """The share of votes for label 1. out: an example vector one of whose examples, of that label, is left out."""
        ids, cos = self.nearest(where, weight) if len(where) else (self.empty, np.zeros(1))
        n, pos = self.total[ids].astype(float), self.positive[ids].astype(float)
        n[ids == out] -= 1
        pos[ids == out] -= label
        w = 1 / (1 - np.minimum(cos, 1) + SOFTEN)
        base = self.positive.sum() / max(1, self.total.sum())
        share = ((w * pos).sum() + base) / ((w * n).sum() + 1)  # one vote of the base rate, so that it is defined without neighbours
        return float(share), ids, cos


def _logit(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _calibrate(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Platt's logistic fit of label shares y / n on x, with a small ridge; falls back to the votes as they are."""
    if not len(x) or y.sum() in (0, n.sum()):
        return 0.0, 1.0
    a, b = 0.0, 1.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        g = np.array([(y - n * p).sum(), ((y - n * p) * x).sum() - 1e-3 * (b - 1)])
        w = n * p * (1 - p) + 1e-9
        h = np.array([[w.sum(), (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a + float(np.clip(step[0], -1, 1)), b + float(np.clip(step[1], -1, 1))
    return (a, b) if b > 0 else (0.0, 1.0)


def _fresh(examples: DataFrame) -> DataFrame:
    """Examples of which none before is a near copy, for the word statistics: a copied document is one witness.

    Near copies are those of five-word shingle sets with a Jaccard similarity of 0.75 or more, compared exactly. Two such sets share one of the
    shingles that each has first, rarest first, up to the number that the other could lack.
    """

    def run(batches):
        for batch in kernel.slices(batches, "text"):
            sets = [s.tobytes() for s in _shingle_sets(kernel.Texts(batch.column("text"), lower=True), SHINGLE_WORDS)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(sets, pa.binary())], names=["row", "shingles"])

    # the shingles of MAX_EXAMPLES texts of EXAMPLE_CHARS characters at most
    found = sorted((r.row, np.frombuffer(r.shingles, dtype=U)) for r in examples.select("row", "text").mapInArrow(run, "row long, shingles binary").toLocalIterator())
    every, count = np.unique(np.concatenate([*(s for _, s in found), np.zeros(0, dtype=U)]), return_counts=True)
    holders: dict[int, list[int]] = {}
    fresh: list[int] = []
    for i, (_, s) in enumerate(found):
        rare = s[np.lexsort((s, count[np.searchsorted(every, s)]))]
        window = rare[: len(s) - -(-SIMILAR[0] * len(s) // SIMILAR[1]) + 1].tolist()
        near = {e for h in window for e in holders.get(h, ())}
        common = ((len(found[e][1]), len(np.intersect1d(s, found[e][1], assume_unique=True))) for e in near)
        if any(SIMILAR[1] * c >= SIMILAR[0] * (len(s) + n - c) for n, c in common):
            continue
        fresh.append(i)
        for h in window:
            holders.setdefault(h, []).append(i)
    return examples.sparkSession.createDataFrame([(found[i][0],) for i in fresh], "row long")


def _count_words(examples: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, int]:
    """The terms of the examples, sorted, in how many and in how many of label 1 each stands, and how many there are; no terms without both labels."""

    def run(batches):
        for batch in kernel.slices(batches, "text"):
            texts, doc, hashes = _terms(batch.column("text"))
            label = np.array(batch.column("label").to_pylist())
            cut = np.searchsorted(doc, np.arange(texts.n + 1))
            out = [np.unique(hashes[a:b]) for a, b in zip(cut, cut[1:])]
            words = np.concatenate([*out, hashes[:0]])
            mark = np.repeat(label, [len(o) for o in out])
            word, at = np.unique(words, return_inverse=True)
            n, pos = np.bincount(at, minlength=len(word)), np.bincount(at, weights=mark, minlength=len(word))
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(pos.astype(np.int64))], names=["word", "n", "pos"])

    totals = examples.agg(F.count("*"), F.sum("label")).first()
    all_n, all_pos = totals[0], totals[1] or 0
    if all_pos in (0, all_n):
        return np.zeros(0, dtype=U), np.zeros(0), np.zeros(0), all_n, all_pos
    counts = examples.select("text", "label").mapInArrow(run, "word long, n long, pos long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    found = counts.toArrow()  # the terms of MAX_EXAMPLES texts at most
    words, n, pos = (found.column(c).to_numpy() for c in ("word", "n", "pos"))
    order = np.argsort(words.view(U))
    return words.view(U)[order], n[order].astype(float), pos[order].astype(float), all_n, all_pos


def _relevance(n: np.ndarray, pos: np.ndarray, all_n: int, all_pos: int) -> np.ndarray:
    """How much a term's presence tells of the label: chi-square, damped where it is what chance gives, and 0 within two standard deviations of that.

    Terms that chance alone would put into fewer than EXPECTED examples of label 1 need to be out of one only: a rare insult has no more to show.
    """
    share = min(max(all_pos / max(1, all_n), 1e-6), 1 - 1e-6)
    chi2 = (pos - n * share) ** 2 / (np.maximum(n, 1) * share * (1 - share)) / (1 - n / (all_n + 1))
    return np.where((n > 0) & (chi2 >= np.where(n * share >= EXPECTED, 4, 1)), chi2 * chi2 / (chi2 + CHANCE), 0.0)


def _frequencies(docs: DataFrame, words: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many documents each word stands, over all documents, and how many documents there are."""

    def run(batches):
        n, df = 0, np.zeros(len(words), dtype=np.int64)
        for batch in kernel.slices(batches, "text"):
            texts, doc, hashes = _terms(batch.column("text"))
            hit, at = _in_words(words, hashes)
            df += np.bincount(np.unique(doc[hit] * max(1, len(words)) + at) % max(1, len(words)), minlength=len(words))[: len(words)]
            n += texts.n
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(df[some], n))], names=["word", "n"])

    found = docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()  # a row per word, and one
    word, n = found.column("word").to_numpy(), found.column("n").to_numpy()
    df = np.zeros(len(words))
    df[word[word >= 0]] = n[word >= 0]
    return df, int(n[word < 0].sum())


@dataclass
class Model:
    """What scoring needs: the index as a broadcast, and the calibration of the votes."""

    shared: object
    calibration: tuple[float, float] = (0.0, 1.0)


def _index(rows: pa.Table, words: np.ndarray, gain: np.ndarray) -> tuple[BlockMaxIndex, np.ndarray, np.ndarray]:
    """The index over example vectors (row, doc_id, label, at, weight as bytes), and for each example's row, in order, its vector's place."""
    groups: dict[tuple, list] = {}
    for row, doc_id, label, at, weight in zip(*(rows.column(c).to_pylist() for c in ("row", "doc_id", "label", "at", "weight"))):
        groups.setdefault((at, weight), []).append((doc_id, label, row))

    def heaviest(key):  # vectors that share their heaviest term are neighbours, so that few blocks have a high maximum of it
        at, weight = np.frombuffer(key[0], dtype=np.int32), np.frombuffer(key[1], dtype=np.float32)
        top = int(weight.argmax()) if len(at) else 0
        return (-float(gain[at[top]]), int(at[top]), -float(weight[top]), key) if len(at) else (1.0, 0, 0.0, key)

    keys = sorted(groups, key=heaviest)
    members = [sorted(groups[k]) for k in keys]
    cut = np.concatenate([[0], np.cumsum([len(at) // 4 for at, _ in keys], dtype=np.int64)])
    vectors = Sparse(cut, np.frombuffer(b"".join(at for at, _ in keys), dtype=np.int32), np.frombuffer(b"".join(w for _, w in keys), dtype=np.float32))
    index = BlockMaxIndex(words, gain, vectors, np.array([len(m) for m in members], dtype=np.int64),
                          np.array([sum(y for _, y, _ in m) for m in members], dtype=np.int64), [[d for d, _, _ in m[:3]] for m in members])
    index.vectors = None  # the postings say it all
    place = sorted((row, i) for i, m in enumerate(members) for _, _, row in m)
    return index, np.array([r for r, _ in place], dtype=np.int64), np.array([i for _, i in place], dtype=np.int64)


def fit(docs: DataFrame, labels: DataFrame, *, max_examples: int = MAX_EXAMPLES, example_chars: int = EXAMPLE_CHARS) -> Model:
    """labels: doc_id, label (0 or 1; others and nulls are ignored; repeated ones count as 1 if one says 1). docs: doc_id, text, all of them.

    Learnt from are the max_examples labelled ids with the smallest hash, those of them whose text is no longer than example_chars.
    """
    spark = docs.sparkSession
    with staging(spark) as stage:
        chosen = labels.filter("label in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(
            F.xxhash64("doc_id"), "doc_id").limit(max_examples)
        picked = stage(chosen)  # max_examples rows at most: safe to broadcast
        texts = docs.select("doc_id", "text").filter(F.coalesce(F.length("text"), F.lit(0)) <= example_chars)
        texts = texts.join(F.broadcast(picked), "doc_id").groupBy(F.xxhash64("doc_id", "text").alias("row")).agg(
            F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.first("label").alias("label"))
        examples = stage(texts)
        words, n_of, pos_of, all_n, all_pos = _count_words(examples.join(F.broadcast(_fresh(examples)), "row"))
        telling = _relevance(n_of, pos_of, all_n, all_pos) > 0
        words, n_of, pos_of = words[telling], n_of[telling], pos_of[telling]
        df, n = _frequencies(docs, words)
        idf = np.log((n + 1) / (df + 1)) + 1
        gain = idf * _relevance(n_of, pos_of, all_n, all_pos)

        def vectors(batches):
            for batch in kernel.slices(batches, "text"):
                got = [(w.astype(np.int32).tobytes(), v.astype(np.float32).tobytes()) for w, v in _vectors(batch.column("text"), words, gain)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row", "doc_id", "label")), pa.array([g[0] for g in got], pa.binary()),
                                                  pa.array([g[1] for g in got], pa.binary())], names=["row", "doc_id", "label", "at", "weight"])

        columns = examples.select("row", "doc_id", "label", "text")
        # at most a posting for each term of max_examples texts of example_chars characters
        index, row_of, place_of = _index(columns.mapInArrow(vectors, "row long, doc_id long, label int, at binary, weight binary").toArrow(), words, gain)
        shared = spark.sparkContext.broadcast(index)  # read once per worker, not once per task

        def left_out(batches):
            index = shared.value
            for batch in kernel.slices(batches, "text"):
                out = []
                for row, label, (at, weight) in zip(batch.column("row").to_pylist(), batch.column("label").to_pylist(), _vectors(batch.column("text"), words, gain)):
                    # as if this example had not been counted: what stands in it alone is no term
                    weight = weight / gain[at] * idf[at] * _relevance(n_of[at] - 1, pos_of[at] - label, all_n - 1, all_pos - label)
                    some = weight > 0
                    weight = weight[some] / np.sqrt((weight[some] ** 2).sum())
                    out.append(_logit(index.votes(at[some], weight, int(place_of[np.searchsorted(row_of, row)]), label)[0]))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.float64()), batch.column("label")], names=["x", "y"])

        seen = columns.mapInArrow(left_out, "x double, y int").toArrow()  # a row per example
    x, y = seen.column("x").to_numpy(), seen.column("y").to_numpy().astype(float)
    order = np.lexsort((y, x))  # sums in the same order each time
    x, y = x[order], y[order]
    return Model(shared, _calibrate(x, y, np.ones(len(x))))


def score(docs: DataFrame, model: Model, carry: list[str] | None = None, prefix: str = "toxicity") -> DataFrame:
    """Columns `carry` with toxicity_score, toxicity_evidence (doc_ids of the nearest examples) and toxicity_cosine (of the nearest).

    A column of `carry` that has the name of a new one is replaced by it; another prefix gives the new ones other names.
    """
    new = [f"{prefix}_score", f"{prefix}_evidence", f"{prefix}_cosine"]
    carry = [c for c in (["doc_id"] if carry is None else carry) if c not in new]
    shared, (a, b) = model.shared, model.calibration

    def run(batches):
        index, seen = shared.value, {}

        def scored(where: np.ndarray, weight: np.ndarray) -> tuple[float, list[int], float]:
            key = hashlib.blake2b(where.tobytes() + np.round(weight, 6).tobytes(), digest_size=16).digest()
            if key not in seen:
                if len(seen) >= CACHE:
                    seen.clear()
                share, ids, cos = index.votes(where, weight)
                seen[key] = (float(1 / (1 + np.exp(-np.clip(a + b * _logit(share), -30, 30)))), [e for i in ids[:3] for e in index.evidence[i][:1]],
                             float(cos[0]) if len(cos) and len(ids) else 0.0)
            return seen[key]

        for batch in kernel.slices(batches, "text"):
            got = [scored(w, v) for w, v in _vectors(batch.column("text"), index.words, index.idf)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carry), pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.list_(pa.int64())),
                 pa.array([g[2] for g in got], pa.float64())], names=[*carry, *new])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*carry).schema)
    return docs.select(*dict.fromkeys([*carry, "text"])).mapInArrow(run, f"{types}, {new[0]} double, {new[1]} array<long>, {new[2]} double")


def held_out(folds: int = 5, fold: int = 0):
    """Rows whose label must not be learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, carry: list[str] | None = None, prefix: str = "toxicity") -> DataFrame:
    """Scores of all documents by the labelled rows (labels: doc_id, toxic) that are not held out.

    Null and empty texts are scored like texts without any of the words. Without labelled rows of both classes there are no words and
    each text gets the base rate. Repeated rows are scored alike; null doc_ids are never examples. Extra columns are not read.
    """
    usable = labels.filter(~held_out()).select("doc_id", F.col("toxic").cast("int").alias("label"))
    return score(docs, fit(docs, usable), carry, prefix)
