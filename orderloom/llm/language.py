"""Language by unigram models over the pieces of a fixed public vocabulary, summed over all segmentations.

Each language has a probability for each piece. A word's likelihood is the sum over all its segmentations of the product of their
pieces' probabilities, found by the forward algorithm; a text's is the product of its words'. The probabilities are learnt by
expectation maximisation on a bounded sample of labelled texts: forward and backward sums give each piece's expected count. The
vocabulary is read, never trained. Pieces are matched on bytes of the lower-cased text; a single byte has a small probability in every
language, so every text has a likelihood. Words of any length are summed over all their segmentations: those over MAX_BYTES bytes, as texts without
blanks have, one by one, in blocks, with sums that are scaled as they go. Only what is learnt from is cut, between letters, to pieces of MAX_BYTES.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from orderloom.llm import kernel
from orderloom.llm.kernel import U
from orderloom.llm.tables import staging

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
EXAMPLES_PER_LANGUAGE = 1_500  # labelled rows learnt from, those with the smallest hash of doc_id
ROUNDS = 3
MAX_BYTES = 60  # of words that are summed side by side
BLOCK_BYTES = 1 << 16  # of a longer word
RESCALE = 32  # bytes between two looks at the scale of its sums
BYTE_PROBABILITY = 1e-6
POOLED = 0.02  # share of the pooled model that is mixed into each language
SCALE = float(np.exp(2.5))  # keeps the forward sums of a word near 1
LENGTHS = (4, 6, 8, 10, 12, 16, 20, 24, 32, 48, MAX_BYTES)
CACHE = 300_000
SPACE_MARK = "▁"  # the vocabulary's mark of a word's beginning


def pieces(path: str) -> list[bytes]:
    """The vocabulary's pieces, lower case, without control and byte pieces; a word's beginning is a blank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    normal = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)))
    found = {p.replace(SPACE_MARK, " ").lower().encode() for p in normal}
    return sorted(p for p in found if p.strip())


class Lattice:
    """All pieces in words of one buffer. Words are given as spans that begin with a blank."""

    def __init__(self, names: list[bytes]):
        buf = np.frombuffer(b"".join(names), dtype=np.uint8)
        ends = np.cumsum([len(p) for p in names])
        starts = ends - np.array([len(p) for p in names])
        hashes = kernel.span_hashes(buf, starts, ends)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[(self.hashes >> U(44)).astype(np.int64)] = True
        self.lengths = sorted({len(p) for p in names})
        self.longest = self.lengths[-1]

    def hits(self, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int):
        """(end, length, rows, pieces) of every piece in words of at most `width` bytes, by rising end."""
        at = np.minimum(starts[:, None] + np.arange(width), len(buf) - 1)
        chars = np.where(np.arange(width) < lengths[:, None], kernel.BYTE_VALUE[buf[at]], U(0))
        up, down = kernel._powers(width + 1)
        total = np.zeros((width + 1, len(starts)), dtype=U)
        np.cumsum((chars * up[:width]).T, axis=0, out=total[1:])
        for end in range(1, width + 1):
            for length in self.lengths:
                if length > end:
                    break
                h = kernel.mix((total[end] - total[end - length]) * down[end - length])
                row = np.flatnonzero(self.maybe[(h >> U(44)).astype(np.int64)])
                if len(row):
                    place = np.minimum(np.searchsorted(self.hashes, h[row]), len(self.hashes) - 1)
                    same = (self.hashes[place] == h[row]) & (end <= lengths[row])
                    if same.any():
                        yield end, length, row[same], self.order[place[same]]


    def spans(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(end, length, piece) of every piece in one span of bytes, by rising end."""
        up, down = kernel._powers(len(word) + 1)
        total = np.zeros(len(word) + 1, dtype=U)
        np.cumsum(kernel.BYTE_VALUE[word] * up[: len(word)], out=total[1:])
        found = []
        for length in self.lengths:
            if length > len(word):
                break
            h = kernel.mix((total[length:] - total[:-length]) * down[: len(word) - length + 1])
            start = np.flatnonzero(self.maybe[(h >> U(44)).astype(np.int64)])
            place = np.minimum(np.searchsorted(self.hashes, h[start]), len(self.hashes) - 1)
            same = self.hashes[place] == h[start]
            found.append((start[same] + length, np.full(same.sum(), length), self.order[place[same]]))
        end, length, piece = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(end, kind="stable")
        return end[order], length[order], piece[order]


def _long_word(lattice: Lattice, p: np.ndarray, word: np.ndarray) -> np.ndarray:
    """As log_likelihoods for one word, block by block: only the sums that pieces can still reach back to are kept."""
    reach = lattice.longest
    tail, log_scale = np.zeros((reach + 1, p.shape[1])), np.zeros(p.shape[1])  # sums of the last places before a block, scaled
    tail[-1] = 1
    weight = [p * SCALE**length for length in range(reach + 1)] if len(p) * reach < 1 << 12 else None
    for start in range(0, len(word), BLOCK_BYTES):
        block = word[max(0, start - reach): start + BLOCK_BYTES]
        shift = min(start, reach)  # bytes of the block that were there before
        ends, lengths, ids = lattice.spans(block)
        forward = np.concatenate([tail, np.zeros((len(block) - shift, p.shape[1]))])
        offset, at = reach - shift, int(np.searchsorted(ends, shift, side="right"))
        for end in range(shift + 1, len(block) + 1):
            here = forward[offset + end - 1] * (BYTE_PROBABILITY * SCALE)
            while at < len(ends) and ends[at] == end:
                length = lengths[at]
                here = here + forward[offset + end - length] * (weight[length][ids[at]] if weight else p[ids[at]] * SCALE**length)
                at += 1
            forward[offset + end] = here
            if end % RESCALE == 0 or end == len(block):
                window = slice(max(0, offset + end - reach), offset + end + 1)
                log_scale += np.log(here)
                forward[window] = forward[window] / here
        tail = forward[-(reach + 1):]
    return np.log(tail[-1]) + log_scale - len(word) * np.log(SCALE)


def _groups(lengths: np.ndarray):
    low = 0
    for width in LENGTHS:
        rows = np.flatnonzero((lengths > low) & (lengths <= width))
        low = width
        for part in np.array_split(rows, max(1, len(rows) * width // (1 << 20))):
            if len(part):
                yield width, part


def log_likelihoods(lattice: Lattice, p: np.ndarray, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each word and language the log of the sum over all segmentations. p: pieces by languages."""
    out = np.zeros((len(starts), p.shape[1]))
    for width, rows in _groups(lengths):
        forward = _forward(width, len(rows), p, list(lattice.hits(buf, starts[rows], lengths[rows], width)))
        out[rows] = np.log(forward[lengths[rows], np.arange(len(rows))]) - lengths[rows, None] * np.log(SCALE)
    for row in np.flatnonzero(lengths > MAX_BYTES):
        out[row] = _long_word(lattice, p, buf[starts[row]: starts[row] + lengths[row]])
    return out


def _forward(width: int, m: int, p: np.ndarray, hits: list) -> np.ndarray:
    forward = np.zeros((width + 1, m, p.shape[1]))
    forward[0] = 1
    done = 0
    for end in range(1, width + 1):
        forward[end] = forward[end - 1] * (BYTE_PROBABILITY * SCALE)
        while done < len(hits) and hits[done][0] == end:
            _, length, rows, ids = hits[done]
            forward[end, rows] += forward[end - length, rows] * (p[ids] * SCALE**length)
            done += 1
    return forward


def expected_counts(lattice: Lattice, p: np.ndarray, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray, language: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Expected occurrences of each piece in each language, of words seen `count` times in `language`."""
    out = np.zeros(p.shape)
    for width, rows in _groups(lengths):
        m, own = len(rows), language[rows]
        hits = list(lattice.hits(buf, starts[rows], lengths[rows], width))
        forward = _forward(width, m, p, hits)[:, np.arange(m), own]
        total = forward[lengths[rows], np.arange(m)]
        backward = np.zeros((width + 1, m))
        backward[lengths[rows], np.arange(m)] = 1
        done = len(hits) - 1
        for end in range(width, 0, -1):
            while done >= 0 and hits[done][0] == end:
                _, length, who, ids = hits[done]
                step = p[ids, own[who]] * SCALE**length
                np.add.at(out, (ids, own[who]), count[rows][who] * forward[end - length, who] * step * backward[end, who] / total[who])
                backward[end - length, who] += step * backward[end, who]
                done -= 1
            backward[end - 1] += backward[end] * (BYTE_PROBABILITY * SCALE)
    return out


def _spans(texts: kernel.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The buffer with a blank in front of each word, the words' spans from that blank, and their texts."""
    buf = np.where(kernel.SPACE[texts.buf], np.uint8(32), texts.buf)
    buf = np.concatenate([np.array([32], dtype=np.uint8), buf])
    return buf, texts.starts, texts.ends + 1, texts.doc  # shifted by the blank that was put in front


def _cut(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The spans, longer ones cut between letters to at most MAX_BYTES."""
    long = ends - starts > MAX_BYTES
    if not long.any():
        return starts, ends, doc
    parts = []
    for start, end, d in zip(starts[long].tolist(), ends[long].tolist(), doc[long].tolist()):
        while start < end:
            stop = min(start + MAX_BYTES, end)
            while stop < end and stop > start + MAX_BYTES - 3 and buf[stop] & 0xC0 == 0x80:
                stop -= 1
            parts.append((start, stop, d))
            start = stop
    more = np.array(parts, dtype=np.int64)
    return tuple(np.concatenate([x[~long], more[:, i]]) for i, x in enumerate((starts, ends, doc)))


@dataclass
class Model:
    languages: list[str]
    names: list[bytes]
    p: np.ndarray  # pieces by languages
    lattice: Lattice | None = None
    known: tuple = field(default_factory=lambda: (np.zeros(0, dtype=U), None))

    def __getstate__(self):
        return {"languages": self.languages, "names": self.names, "p": self.p.astype(np.float32), "lattice": None, "known": (np.zeros(0, dtype=U), None)}

    def score(self, column: pa.Array) -> np.ndarray:
        """Log likelihoods of texts (lower case) by language."""
        if self.lattice is None:
            self.lattice, self.p = Lattice(self.names), self.p.astype(float)
        texts = kernel.Texts(column)
        buf, starts, ends, doc = _spans(texts)
        out = np.zeros((texts.n, len(self.languages)))
        if not len(starts):
            return out
        words, first, place = np.unique(kernel.span_hashes(buf, starts, ends), return_index=True, return_inverse=True)
        value = np.empty((len(words), len(self.languages)))
        keys, cached = self.known
        at = np.minimum(np.searchsorted(keys, words), max(0, len(keys) - 1))
        hit = keys[at] == words if len(keys) else np.zeros(len(words), dtype=bool)
        if len(keys):
            value[hit] = cached[at[hit]]
        new = ~hit
        value[new] = log_likelihoods(self.lattice, self.p, buf, starts[first[new]], (ends - starts)[first[new]])
        if len(keys) < CACHE:
            every = np.concatenate([keys, words[new]])
            order = np.argsort(every)
            self.known = every[order], np.concatenate([cached, value[new]] if len(keys) else [value[new]])[order]
        for g in range(len(self.languages)):
            out[:, g] = np.bincount(doc, weights=value[place, g], minlength=texts.n)
        return out


def fit(examples: DataFrame, *, vocabulary: str = VOCABULARY, per_language: int = EXAMPLES_PER_LANGUAGE, rounds: int = ROUNDS) -> Model:
    """A model of `examples` (doc_id, text, lang); rows with a null or empty language or text are not learnt from."""
    stage = staging(examples.sparkSession)
    names = pieces(vocabulary)
    usable = examples.filter("lang is not null and lang <> '' and text is not null").select("doc_id", F.lower("text").alias("text"), "lang")
    ranked = usable.select("doc_id", "lang", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")).alias("rank_"))
    chosen = stage(ranked.filter(F.col("rank_") <= per_language).select(F.col("doc_id").alias("id_"), F.col("lang").alias("lang_")))
    # per_language ids for each language: safe to broadcast
    sample = usable.join(F.broadcast(chosen), (F.col("doc_id") == F.col("id_")) & (F.col("lang") == F.col("lang_")), "left_semi")
    languages = sorted(r.lang_ for r in chosen.select("lang_").distinct().collect())
    if not languages:
        return Model([], names, np.zeros((len(names), 0)))
    number = {name: i for i, name in enumerate(languages)}

    def words(batches):
        for batch in kernel.slices(batches, "text"):
            buf, *spans = _spans(kernel.Texts(batch.column("text")))
            starts, ends, doc = _cut(buf, *spans)
            lang = np.array([number[x] for x in batch.column("lang").to_pylist()], dtype=np.int64)[doc]
            _, first, count = np.unique(kernel.span_hashes(buf, starts, ends) + lang.astype(U), return_index=True, return_counts=True)
            raw = buf.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(lang[first]), pa.array([raw[a:b] for a, b in zip(starts[first], ends[first])], pa.binary()), pa.array(count)],
                                             names=["language", "word", "n"])

    counted = stage(sample.select("text", "lang").mapInArrow(words, "language long, word binary, n long").groupBy("language", "word").agg(F.sum("n").alias("n")))
    p = np.full((len(names), len(languages)), 1 / len(names))
    for _ in range(rounds):
        def expect(batches, p=p):
            lattice, total = Lattice(names), np.zeros(p.shape)
            for batch in batches:
                raw = batch.column("word").to_pylist()
                ends = np.cumsum([len(w) for w in raw])
                lengths = np.array([len(w) for w in raw])
                total += expected_counts(lattice, p, np.frombuffer(b"".join(raw), dtype=np.uint8), ends - lengths, lengths,
                                         batch.column("language").to_numpy(), batch.column("n").to_numpy().astype(float))
            piece, language = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(language), pa.array(total[piece, language])], names=["piece", "language", "n"])

        rows = counted.mapInArrow(expect, "piece long, language long, n double").groupBy("piece", "language").agg(F.sum("n").alias("n")).toPandas()
        n = np.zeros(p.shape)  # pieces by languages: bounded by the vocabulary
        n[rows["piece"], rows["language"]] = rows["n"]
        pooled = (n.sum(axis=1, keepdims=True) + 0.1) / (n.sum() + 0.1 * len(names))
        p = (1 - POOLED) * n / np.maximum(n.sum(axis=0, keepdims=True), 1e-9) + POOLED * pooled
    return Model(languages, names, p)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of each row of docs (doc_id, text): the likeliest language and its posterior under equal priors; und and
    0 for texts that are null or have no letter, and if no language was learnt."""
    languages = model.languages

    def run(batches):
        for batch in kernel.slices(batches, "text"):
            letters = np.array([bool(x) for x in batch.column("letters_").to_pylist()])
            if languages:
                value = model.score(batch.column("text"))
                value = np.exp(value - value.max(axis=1, keepdims=True))
                best, share = value.argmax(axis=1), value.max(axis=1) / value.sum(axis=1)
            else:
                letters[:] = False
            pred = [languages[best[i]] if ok else "und" for i, ok in enumerate(letters)]
            score = [float(share[i]) if ok else 0.0 for i, ok in enumerate(letters)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    ready = docs.select("doc_id", F.lower("text").alias("text"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters_"))
    return ready.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def held_out(folds: int = 4, fold: int = 2):
    """Rows whose language must not be learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(False))


def language(docs: DataFrame, *, vocabulary: str = VOCABULARY) -> DataFrame:
    """Predictions for all documents (doc_id, text, lang), learnt from those that are not held out. Repeated rows are predicted alike."""
    return predict(docs, fit(docs.filter(~held_out()), vocabulary=vocabulary))
