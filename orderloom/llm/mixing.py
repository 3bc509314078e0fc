"""Mixing sources to target weights, by balanced sampling with the cube method.

Each source gets a target of words. A document is taken floor(target / source size) times, and once more with the fraction that is
left as inclusion probability. The cube method makes these choices: it moves the fractional probabilities along vectors of the null
space of the constraints (words and documents of the source stay as expected) until a coordinate reaches 0 or 1. It flies in chunks of
about CHUNK documents of one source; each leaves at most two undecided, which meet in new chunks, until one chunk per source is left.
Only its landing, two documents at most, gives up the constraints: first the documents, then the words.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from orderloom.llm.tables import staging

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
CHUNK = 512
SEED = 20
EPS = 1e-9
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text="text"):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def flight(pi: np.ndarray, size: np.ndarray, rng: np.random.Generator, land: bool) -> np.ndarray:
    """Inclusion probabilities moved to 0 or 1 with sum(pi) and sum(pi * size) kept, but for two at most; land: those too."""
    pi = pi.astype(float).tolist()
    size = size.astype(float).tolist()
    draws = rng.random(len(pi) + 8).tolist()
    free: list[int] = []
    queue = iter(i for i, p in enumerate(pi) if EPS < p < 1 - EPS)
    step = 0

    def move(units: list[int], u: list[float]) -> None:
        nonlocal step
        up = min((1 - pi[i]) / v if v > 0 else pi[i] / -v for i, v in zip(units, u) if v)
        down = min(pi[i] / v if v > 0 else (1 - pi[i]) / -v for i, v in zip(units, u) if v)
        by = up if draws[step] * (up + down) < down else -down
        step += 1
        for i, v in zip(units, u):
            p = pi[i] + by * v
            pi[i] = 0.0 if p < EPS else 1.0 if p > 1 - EPS else p

    def settle() -> None:
        free[:] = [i for i in free if 0.0 < pi[i] < 1.0]

    while True:
        for i in queue:
            free.append(i)
            if len(free) == 3:
                break
        if len(free) < 3:
            break
        a, b, c = (size[i] for i in free)
        u = [b - c, c - a, a - b]
        top = max(map(abs, u))
        move(free, [v / top for v in u] if top > 0 else [1.0, -1.0, 0.0])
        settle()
    if land:
        while free:
            if len(free) > 1:
                move(free[:2], [1.0, -1.0])
            else:
                move(free, [1.0])
            settle()
    return np.array(pi)


def _targets(sources: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """sources: source, source_size, n_docs. Adds rank, target: shares by weight, none above cap times its source's size."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1  # one row per source
    ranked = sources.withColumn("rank", place).withColumn("weight", F.get(F.array(*map(F.lit, map(float, weights))), F.col("rank") % len(weights)))
    top = cap * F.col("source_size")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    per_weight = 0.0
    while True:  # ends when no further source reaches its cap; each round caps one at least
        full = (F.col("weight") * per_weight >= top)
        at_cap, rest = ranked.agg(F.sum(F.when(full, top)), F.sum(F.when(~full, F.col("weight")))).first()
        new = (share * total - (at_cap or 0.0)) / rest if rest else per_weight
        if new <= per_weight:
            break
        per_weight = new
    return ranked.withColumn("target", F.least(top, F.col("weight") * per_weight))


def _fly(units: DataFrame, land: bool, level: int) -> DataFrame:
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rank, chunk = (k.as_py() for k in key)
        order = np.lexsort((table.column("copy").to_numpy(), table.column("row_key").to_numpy()))
        table = table.take(pa.array(order))
        rng = np.random.default_rng([SEED, level, rank, chunk])
        order = rng.permutation(len(order))
        table = table.take(pa.array(order))
        pi = flight(table.column("pi").to_numpy(), table.column("size").to_numpy(), rng, land)
        return table.set_column(table.column_names.index("pi"), "pi", pa.array(pi, pa.float64())).drop_columns(["chunk"])

    schema = "rank int, row_key long, copy long, doc_id long, size long, pi double"
    return units.select("rank", "chunk", "row_key", "copy", "doc_id", "size", "pi").groupBy("rank", "chunk").applyInArrow(run, schema)


def row_key(docs: DataFrame):
    """Names a row by all that is in it; repeated rows share it."""
    return F.xxhash64(*[docs[c] for c, kind in docs.dtypes if "map<" not in kind])


def mix(docs: DataFrame, *, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP, chunk: int = CHUNK) -> DataFrame:
    """One row per document (doc_id, source, text, ...): doc_id, source, size, source_size, target, copies, taken, row_key.

    Sources, ordered by code point with null last, have the weights in turn and share `share` times all words, none above `cap` times
    its own. size: words, 0 for null texts; documents of size 0 and sources of size 0 are taken 0 words. Repeated rows are documents of
    their own. The same rows give the same choices in each run. An empty table gives an empty result.
    """
    stage = staging(docs.sparkSession)
    rows = docs.select("doc_id", "source", n_words().alias("size"), row_key(docs).alias("row_key"))
    rows = stage(rows.groupBy("row_key", "doc_id", "source", "size").agg(F.count("*").alias("same")))
    sources = stage(rows.groupBy("source").agg(F.sum(F.col("size") * F.col("same")).alias("source_size"), F.sum("same").alias("n_docs")))
    targets = stage(_targets(sources, weights, share, cap))
    ratio = F.when(F.col("source_size") > 0, F.least(F.lit(cap), F.col("target") / F.col("source_size"))).otherwise(0.0)
    targets = targets.withColumn("base", F.floor(ratio)).withColumn("pi", ratio - F.floor(ratio)).select(
        F.col("source").alias("source_"), "source_size", "n_docs", "rank", "target", "base", "pi")
    known = rows.join(targets, F.col("source").eqNullSafe(F.col("source_"))).drop("source_")
    known = stage(known.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("same")))).drop("same"))
    units = known.select("rank", "row_key", "copy", "doc_id", "size", "pi", "n_docs").filter((F.col("pi") > EPS) & (F.col("pi") < 1 - EPS))
    decided, level = [known.filter((F.col("pi") <= EPS) | (F.col("pi") >= 1 - EPS)).select("row_key", "copy", F.round("pi").alias("pi"))], 0
    while True:
        left = stage(units.groupBy("rank").agg(F.count("*").alias("left")))
        most = left.agg(F.max("left")).first()[0]
        if not most:
            break
        land = most <= chunk
        dealt = units.drop("n_docs").join(left, "rank").withColumn(
            "chunk", F.pmod(F.xxhash64("row_key", "copy", F.lit(level)), F.ceil(F.col("left") / chunk)).cast("int"))
        flown = stage(_fly(dealt, land, level))
        done = (F.col("pi") <= EPS) | (F.col("pi") >= 1 - EPS)
        decided.append(flown.filter(done).select("row_key", "copy", "pi"))
        if land:
            break
        units, level = flown.filter(~done), level + 1
    chosen = decided[0]
    for part in decided[1:]:
        chosen = chosen.unionByName(part)
    copies = (F.col("base") + F.col("chosen")).cast("long")
    return known.drop("pi").join(chosen.withColumnRenamed("pi", "chosen"), ["row_key", "copy"]).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), "row_key")


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs`, with all their columns, each as often as the mix takes it."""
    columns = docs.columns
    taken = mix(docs, **options).groupBy("row_key").agg(F.sum("copies").alias("copies_"), F.count("*").alias("same_")).filter("copies_ > 0")
    rows = docs.withColumn("row_key_", row_key(docs)).join(taken.withColumnRenamed("row_key", "row_key_"), "row_key_")
    once = rows.filter("same_ = 1").unionByName(rows.filter("same_ > 1").dropDuplicates(["row_key_"]))
    return once.withColumn("time_", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies_")))).select(*columns)
