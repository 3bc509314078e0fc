"""Quality by a learned decision list over document statistics.

Sequential covering on labelled statistics (bounded sample): a rule is grown condition by condition by FOIL's information gain on two
thirds of the rows, pruned from its end on the other third, and kept if it is precise there; the rows it covers are taken out, and the
next rule is learnt on the rest. The list is emitted as one ordered conditional expression over the statistics' columns.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm import kernel
from orderloom.llm.kernel import U
from orderloom.llm.tables import staging

MAX_EXAMPLES = 20_000  # labelled rows the list is learnt on, those with the smallest hash of doc_id
REPEAT_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_CONDITIONS = 4
MAX_RULES = 16
MIN_PRECISION = 0.95
MIN_COVERED = 8
THRESHOLDS = 48
SYMBOLS = b"#*$%&|<>"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_upper_words", "n_digits",
          "n_marks", "n_word_lines", "n_twin_words", "max_word_count"]
STATISTICS = {
    "mean_word_chars": ("word_chars", "n_words"), "symbol_share": ("n_symbols", "word_chars"), "dup_line_share": ("n_dup_lines", "n_word_lines"),
    "repeat_share": ("n_repeat_words", "n_words"), "distinct_share": ("n_distinct_words", "n_words"), "upper_share": ("n_upper_words", "n_words"),
    "digit_share": ("n_digits", "word_chars"), "mark_share": ("n_marks", "word_chars"), "words_per_line": ("n_words", "n_word_lines"),
    "twin_share": ("n_twin_words", "n_words"), "top_word_share": ("max_word_count", "n_words"),
}


def _flags(values: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(values)] = True
    return out


SYMBOL, DIGIT, MARK = _flags(SYMBOLS), _flags(b"0123456789"), _flags(b"!?\"'();:=+_~^\\/@[]{}-")
UPPER, LOWER = _flags(bytes(range(65, 91))), _flags(bytes(range(97, 123)))


def _repeats(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values made distinct per document: for each row how often its value stands in its document, and the documents of the distinct ones."""
    own = kernel.mix(value + kernel.mix(doc.astype(U)))
    _, first, place, count = np.unique(own, return_index=True, return_inverse=True, return_counts=True)
    return count[place], doc[first], count


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """COUNTS of each text; a null text counts as empty."""
    t = kernel.Texts(column)
    n, words = t.n, t.n_words()
    starts = np.concatenate([[0], t.doc_ends[:-1]]).astype(np.int64)

    def per_doc(flag):
        return np.add.reduceat(flag.astype(np.int64), starts) if n else np.zeros(0, dtype=np.int64)

    inside = ~kernel.SPACE[t.buf]
    hashes = t.hashes()
    value, at = kernel.grams(hashes, t.doc, REPEAT_WORDS)
    often, _, _ = _repeats(t.doc[at], value)
    cover = np.zeros(len(hashes) + 1, dtype=np.int64)
    twice = at[often >= 2]
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + REPEAT_WORDS, -1)
    repeated = np.cumsum(cover)[:-1] > 0
    # lines end at each line feed; the one after a text is its end
    line_ends = np.flatnonzero(t.buf == 10)
    line_starts = np.concatenate([[0], line_ends[:-1] + 1]).astype(np.int64)
    line_doc = np.searchsorted(t.doc_ends, line_starts, side="right")
    has_word = np.zeros(len(line_ends), dtype=bool)
    has_word[np.searchsorted(line_ends, t.starts)] = True
    lines = kernel.span_hashes(t.buf, line_starts[has_word], line_ends[has_word])
    _, distinct_line_doc, _ = _repeats(line_doc[has_word], lines)
    word_lines = np.bincount(line_doc[has_word], minlength=n)
    word_often, distinct_word_doc, word_count = _repeats(t.doc, hashes)
    most = np.zeros(n, dtype=np.int64)
    np.maximum.at(most, distinct_word_doc, word_count)
    twin = np.zeros(len(hashes), dtype=bool)
    if len(hashes) > 1:
        twin[1:] = (hashes[1:] == hashes[:-1]) & (t.doc[1:] == t.doc[:-1])
    upper = np.concatenate([[0], np.cumsum(UPPER[t.buf])])
    lower = np.concatenate([[0], np.cumsum(LOWER[t.buf])])
    shouted = (upper[t.ends] - upper[t.starts] >= 2) & (lower[t.ends] == lower[t.starts])
    return {
        "n_words": words, "word_chars": per_doc(inside & ((t.buf & 0xC0) != 0x80)), "n_symbols": per_doc(SYMBOL[t.buf]),
        "n_dup_lines": word_lines - np.bincount(distinct_line_doc, minlength=n), "n_repeat_words": np.bincount(t.doc[repeated], minlength=n),
        "n_lines": np.bincount(line_doc, minlength=n), "n_distinct_words": np.bincount(distinct_word_doc, minlength=n),
        "n_upper_words": np.bincount(t.doc[shouted], minlength=n), "n_digits": per_doc(DIGIT[t.buf]), "n_marks": per_doc(MARK[t.buf]),
        "n_word_lines": word_lines, "n_twin_words": np.bincount(t.doc[twin], minlength=n), "max_word_count": most,
    }


def with_counts(docs: DataFrame, carry: list[str]) -> DataFrame:
    """Columns `carry` with COUNTS of the whole text."""
    def run(batches):
        for batch in kernel.slices(batches, "text"):
            got = measure(batch.column("text"))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carry), *(pa.array(got[c].astype(np.int64)) for c in COUNTS)], names=[*carry, *COUNTS])

    types = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*carry).schema), *(f"{c} long" for c in COUNTS)])
    return docs.select(*dict.fromkeys([*carry, "text"])).mapInArrow(run, types)


def statistic(name: str) -> Column:
    top, bottom = STATISTICS[name]
    return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(0.0)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool  # value >= threshold, else value <= threshold
    threshold: float

    def holds(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        value = x[:, names.index(self.name)]
        return value >= self.threshold if self.above else value <= self.threshold

    def column(self) -> Column:
        return statistic(self.name) >= self.threshold if self.above else statistic(self.name) <= self.threshold

    def __str__(self) -> str:
        return f"{self.name} {'>=' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, x: np.ndarray, names: list[str]) -> np.ndarray:
    return reduce(operator.and_, (c.holds(x, names) for c in rule), np.ones(len(x), dtype=bool))


def _relaxed(c: Condition, others: np.ndarray) -> Condition:
    """The threshold moved halfway to the nearest of the rows to keep that it shuts out."""
    out = others[others < c.threshold] if c.above else others[others > c.threshold]
    if not len(out):
        return c
    return Condition(c.name, c.above, float(c.threshold + (out.max() if c.above else out.min())) / 2)


def _grow(x: np.ndarray, y: np.ndarray, names: list[str]) -> Rule:
    rule: list[Condition] = []
    inside = np.ones(len(x), dtype=bool)
    while len(rule) < MAX_CONDITIONS and (~y[inside]).any():
        p0, n0 = y[inside].sum(), (~y[inside]).sum()
        if not p0:
            break
        best, gain = None, 1e-9
        for j, name in enumerate(names):
            value = x[inside, j]
            for t in np.unique(np.quantile(value[y[inside]], np.linspace(0, 1, THRESHOLDS), method="nearest")):
                for above in (True, False):
                    hit = value >= t if above else value <= t
                    p, n = (hit & y[inside]).sum(), (hit & ~y[inside]).sum()
                    if p and (g := p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))) > gain:
                        best, gain = Condition(name, above, float(t)), g
        if best is None:
            break
        best = _relaxed(best, x[inside & ~y, names.index(best.name)])
        rule.append(best)
        inside &= best.holds(x, names)
    return tuple(rule)


def _prune(rule: Rule, x: np.ndarray, y: np.ndarray, names: list[str]) -> tuple[Rule, float]:
    """The beginning of the rule that does best on held-out rows, and its precision there."""
    best, value, precision = (), -2.0, 0.0
    for length in range(1, len(rule) + 1):
        hit = _covers(rule[:length], x, names)
        p, n = (hit & y).sum(), (hit & ~y).sum()
        worth = (p - n) / (p + n) if p + n else -1.0
        if worth > value + 1e-12:
            best, value, precision = rule[:length], worth, p / (p + n) if p + n else 0.0
    return best, precision


def learn(x: np.ndarray, y: np.ndarray, names: list[str]) -> list[Rule]:
    """An ordered list of rules that cover rows with y true."""
    rules: list[Rule] = []
    grow = np.arange(len(x)) % 3 != 2
    left = np.ones(len(x), dtype=bool)
    while len(rules) < MAX_RULES and (y & left & grow).sum() >= MIN_COVERED:
        rule = _grow(x[left & grow], y[left & grow], names)
        if not rule:
            break
        held = left & ~grow
        rule, precision = _prune(rule, x[held], y[held], names)
        hit = _covers(rule, x, names) & left if rule else np.zeros(len(x), dtype=bool)
        if not rule or precision < MIN_PRECISION or (hit & y).sum() < MIN_COVERED or (hit & y).sum() < MIN_PRECISION * hit.sum():
            break
        rules.append(rule)
        left &= ~hit
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The first rule that covers a row, as its number from 1, or null: the row is kept."""
    out = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(reduce(operator.and_, (c.column() for c in rule)), F.lit(number)).otherwise(out)
    return out


def fit(docs: DataFrame, labels: DataFrame, *, max_examples: int = MAX_EXAMPLES) -> list[Rule]:
    """Rules for labels (doc_id, label: true for rows to reject), learnt on rows that pass the base rules. A doc_id with several labels counts
    as true if one is. Without rows of both kinds the list is empty."""
    stage = staging(docs.sparkSession)
    chosen = stage(labels.filter("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(max_examples))  # safe to broadcast
    names = list(STATISTICS)
    sample = with_counts(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), ["doc_id", "label"])
    rows = sample.filter(~base_failed()).select(F.xxhash64("doc_id"), "doc_id", "label", *(statistic(n).alias(n) for n in names)).distinct().collect()
    rows.sort(key=tuple)
    if len({r.label for r in rows}) < 2:
        return []
    return learn(np.array([[r[n] for n in names] for r in rows], dtype=float), np.array([bool(r.label) for r in rows]), names)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, COUNTS, base_failed, rule (the number of the rule that rejects it, from 1, or null), kept. labels: doc_id, quality (0 is rejected).

    Null, empty and blank texts have no words and fail the base rules. Repeated rows are judged alike. Shares with nothing below are 0.
    """
    rules = fit(docs, labels.filter("quality in (0, 1)").select("doc_id", (F.col("quality") == 0).alias("label")))
    return with_counts(docs.select("doc_id", "text"), ["doc_id"]).withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules)).withColumn(
        "kept", ~F.col("base_failed") & F.col("rule").isNull())
