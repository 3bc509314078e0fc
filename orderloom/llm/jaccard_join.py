"""Exact self-join of documents by the Jaccard distance of their word shingles, in the metric space that distance spans.

A link is a distance of at most r = 1 - threshold. The plan:

1. Documents with equal shingle sets (distance 0) become one point that carries the number of its copies.
2. The first pivots are single shingles, ordered by how many points hold them, rarest first. A point lies in the cells of the
   pivots in its window: its first n - ceil(threshold * n) + 1 shingles. Two points within r share a pivot of both windows,
   since neither can lack more of the other's shingles than that. Pivots of one point only join nothing and are left out,
   which leaves the few points that can have a partner at all. Cells that share a point make one region.
3. A region of more than CELL_POINTS points is split into the Voronoi cells of pivots taken from its own points. A point
   belongs to the cell of its nearest pivot p, or to the cell of the far points if d(x, p) > f. It is replicated to each cell q
   with d(x, q) <= min(d(x, p) + 2 r, f + r), and to that of the far points if d(x, p) > f - r: by the triangle inequality, all
   partners of a point of a cell are then in that cell. As f + r is below 1, points that have nothing in common with a pivot
   stay out of its cell. Cells are split again until they are small. A split that would not halve the comparisons (most points
   lie within 2 r of each other) is not carried out, and no point replicated: such a cell is dealt into blocks, every two of
   which are joined. A block is one row that writes each of its shingles once, as points that are alike share most of them.
4. In a cell all points are compared exactly, by counting common shingles. Only sums and forest edges leave a cell, no pairs.
   Shingles that no other point holds cannot be common and stay behind; they count in the size n of a set.

No candidate is capped, sampled or dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from orderloom.llm import blocks, kernel
from orderloom.llm.components import components
from orderloom.llm.kernel import U
from orderloom.llm.tables import staging

WORDS = 5
THRESHOLD = (75, 100)
CELL_POINTS = 1024
CELL_SHINGLES = 1 << 20
PIVOTS = 16  # 100 at most
MAX_DEPTH = 12


def _shingle_sets(texts: kernel.Texts, words: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text; a text of fewer words is one shingle, one without words has none."""
    hashes = texts.hashes()
    value, at = kernel.grams(hashes, texts.doc, words)
    cut = np.searchsorted(texts.doc[at], np.arange(texts.n + 1))
    out = []
    for d in range(texts.n):
        first, last = texts.first[d], texts.first[d + 1]
        if last - first >= words:
            out.append(np.unique(value[cut[d]: cut[d + 1]]))
        elif last > first:
            whole = np.array([last - first], dtype=U)
            for h in hashes[first:last]:
                whole = kernel.mix(whole * kernel.STEP[0] + h)
            out.append(whole)
        else:
            out.append(hashes[:0])
    return out


def _key(shingles: np.ndarray) -> str | None:
    """A 128-bit fingerprint of a set."""
    if not len(shingles):
        return None
    return "".join(f"{int(kernel.mix(shingles ^ salt).sum(dtype=U)):016x}" for salt in (kernel.STEP[30], kernel.STEP[31]))


def _keyed(docs: DataFrame, words: int, carry: list[str], texts_once: bool) -> DataFrame:
    """Columns `carry` with set_key_ and n_; with texts_once only the first row of each key of a task, its text packed."""

    def run(batches):
        seen: set[str] = set()
        for batch in kernel.slices(batches, "text"):
            sets = _shingle_sets(kernel.Texts(batch.column("text"), lower=True), words)
            keys = [_key(s) for s in sets]
            if texts_once:
                new = [k is not None and k not in seen and not seen.add(k) for k in keys]
                keep = pa.array(np.flatnonzero(new))
                batch, keys, sets = batch.take(keep), [k for k, n in zip(keys, new) if n], [s for s, n in zip(sets, new) if n]
            cols = [kernel.packed(batch.column(c)) if texts_once and c == "text" else batch.column(c) for c in carry]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(keys, pa.string()), pa.array([len(s) for s in sets], pa.int64())],
                                             names=[*carry, "set_key_", "n_"])

    wanted = docs.select(*dict.fromkeys([*carry, "text"]))
    types = ", ".join(f"`{f.name}` {'binary' if texts_once and f.name == 'text' else f.dataType.simpleString()}" for f in docs.select(*carry).schema) if carry else ""
    return wanted.mapInArrow(run, f"{types}{', ' if types else ''}set_key_ string, n_ long")


def _candidates(points: DataFrame, words: int, threshold: tuple[int, int], n_blocks: int, n_buckets: int) -> DataFrame:
    """Points whose window holds a shingle of another point: key, window (those shingles) and all shingles that other points hold. Texts come packed."""
    num, den = threshold

    def of_block(table: pa.Table):
        seen: set[str] = set()
        whole = (pa.record_batch([b.column("set_key_"), kernel.unpacked(b.column("text"))], names=["set_key_", "text"]) for b in table.to_batches())
        for batch in kernel.slices(whole, "text"):
            for shingles, key in zip(_shingle_sets(kernel.Texts(batch.column("text"), lower=True), words), batch.column("set_key_").to_pylist()):
                if key not in seen:
                    seen.add(key)
                    yield key, shingles

    def request(block, table, found):
        every = np.concatenate([s for _, s in of_block(table)])
        keys, counts = np.unique(every, return_counts=True)
        return blocks.ask(block, 0, keys, counts, n_buckets, blocks.SHORT)

    def use(table, found):
        rows = list(of_block(table))
        keys = np.unique(np.concatenate([s for _, s in rows]))
        rank, out = found[0], {"key": [], "n": [], "window": [], "shingles": []}
        for key, shingles in rows:
            n = len(shingles)
            seen_by = rank[np.searchsorted(keys, shingles)]
            window = np.argsort(seen_by, kind="stable")[: n - -(-n * num // den) + 1]
            window = window[seen_by[window] > 0]
            if len(window):
                out["key"].append(key)
                out["n"].append(n)
                out["window"].append(shingles[window].view(np.int64))
                out["shingles"].append(shingles[seen_by > 0].tobytes())
        return pa.table([pa.array(out["key"], pa.string()), pa.array(out["n"], pa.int64()), pa.array(out["window"], pa.list_(pa.int64())),
                         pa.array(out["shingles"], pa.binary())], names=list(out))

    def log_rank(counts):
        """0 for one point, then rising with the logarithm: an order of the pivots, the same wherever a shingle stands."""
        return np.minimum(255, np.ceil(8 * np.log2(np.maximum(counts, 1)))).astype(np.uint8)

    routed = points.withColumn("block", F.pmod(F.xxhash64("set_key_"), F.lit(n_blocks))).select("block", "set_key_", "text")
    answers = blocks.answered(routed, None, request, width=blocks.SHORT, encode=log_rank)
    return blocks.with_answers(routed, answers, use, "key string, n long, window array<long>, shingles binary", np.uint8)


def _regions(candidates: DataFrame, stage) -> DataFrame:
    """(v, root): points whose windows are joined, directly or through others, by common pivots."""
    held = candidates.select(F.explode("window").alias("pivot"), F.col("key"))
    least = held.groupBy("pivot").agg(F.min("key").alias("b"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return components(held.join(least, "pivot").select(F.col("key").alias("a"), "b"), stage)


def _frozen(rows: pa.Table) -> tuple[bytes, bytes]:
    """Points as one compressed block without their shingles but with the places of these, and the block's distinct shingles, the most common first."""
    sets = [np.frombuffer(raw, dtype=U) for raw in rows.column("shingles").to_pylist()]
    value, where, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(-often, kind="stable")
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    sizes = np.array([len(s) for s in sets])
    place, owner = place[where.ravel()], np.repeat(np.arange(len(sets)), sizes)
    place = place[np.lexsort((place, owner))]
    steps = np.diff(place, prepend=0)
    starts = np.cumsum(sizes) - sizes
    steps[starts[sizes > 0]] = place[starts[sizes > 0]]
    steps = pa.ListArray.from_arrays(pa.array(np.append(starts, sizes.sum()), pa.int32()), pa.array(steps, pa.uint32()))
    rows = rows.drop_columns(["shingles"]).append_column("steps", steps).combine_chunks()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes(), value[order].tobytes()


def _thawed(block: bytes, shingles: bytes) -> pa.Table:
    rows, value = pa.ipc.open_stream(block).read_all(), np.frombuffer(shingles, dtype=U)
    steps = rows.column("steps").combine_chunks()
    ends, steps = steps.offsets.to_numpy().tolist(), steps.values.to_numpy().astype(np.int64)
    raw = [value[np.cumsum(steps[a:b])].tobytes() for a, b in zip(ends, ends[1:])]
    return rows.drop_columns(["steps"]).append_column("shingles", pa.array(raw, pa.binary()))


def _blocks(cells: DataFrame, big: DataFrame, radius: float, stage) -> DataFrame:
    """Each big cell in blocks of about CELL_POINTS / 2 points; every point knows which of the cells of PIVOTS points, and of the far points after them,
    would be its own and which would have it. in_cell: how many of a block's points each of those cells would have."""
    far = 1 - 1.5 * radius
    inside = cells.join(big.select("cell", "blocks_"), "cell")
    ranked = inside.select("cell", "blocks_", "key", "n", "shingles",
                           F.row_number().over(Window.partitionBy("cell").orderBy(F.xxhash64("cell", "key"), "key")).alias("rank_"))
    chosen = stage(ranked.filter(F.col("rank_") <= PIVOTS).select("cell", "key", "n", "shingles", "blocks_"))
    pivots = chosen.select("cell", "key", "n", "shingles", F.explode(F.sequence(F.lit(0), F.col("blocks_") - 1)).alias("block"))
    points = inside.select("cell", F.pmod(F.xxhash64("key"), F.col("blocks_")).cast("int").alias("block"), "blocks_", "key", "n", "copies", "shingles", "home")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({"cell": pa.array([], pa.string()), "block": pa.array([], pa.int32()), "blocks_": pa.array([], pa.int32()),
                             "in_cell": pa.array([], pa.list_(pa.int64())), "rows": pa.array([], pa.binary()), "shingles": pa.array([], pa.binary())})
        pivots = sorted(zip(*(right.column(c).to_pylist() for c in ("key", "n", "shingles"))))
        size, pivots = np.array([n for _, n, _ in pivots]), [np.frombuffer(raw, dtype=U) for _, _, raw in pivots]
        nearest, near, in_cell = [], [], np.zeros(len(pivots) + 1, dtype=np.int64)
        for n, raw in zip(left.column("n").to_pylist(), left.column("shingles").to_pylist()):
            x = np.frombuffer(raw, dtype=U)
            common = np.array([np.count_nonzero(p[np.minimum(np.searchsorted(p, x), len(p) - 1)] == x) for p in pivots])
            distance = 1 - common / (n + size - common)
            least = distance.min()
            nearest.append(int(np.argmin(distance)) if least <= far else len(pivots))
            near.append(np.flatnonzero(np.append(distance <= min(least + 2 * radius, far + radius) + 1e-9, least > far - radius - 1e-9)).tolist())
            in_cell[near[-1]] += 1
        rows = left.select(["key", "n", "copies", "shingles", "home"]).append_column("nearest", pa.array(nearest, pa.int8())).append_column(
            "near", pa.array(near, pa.list_(pa.int8())))
        rows, shingles = _frozen(rows)
        return pa.table({**{c: left.column(c).slice(0, 1) for c in ("cell", "block", "blocks_")}, "in_cell": pa.array([in_cell.tolist()], pa.list_(pa.int64())),
                         "rows": pa.array([rows], pa.binary()), "shingles": pa.array([shingles], pa.binary())})

    return stage(points.groupBy("cell", "block").cogroup(pivots.groupBy("cell", "block")).applyInArrow(
        run, "cell string, block int, blocks_ int, in_cell array<long>, rows binary, shingles binary"))


def _split(blocks_of: DataFrame) -> DataFrame:
    """The Voronoi cells of blocks, with the replicas that the triangle inequality asks for."""
    def run(batches):
        for batch in batches:
            for name, *block in zip(*(batch.column(c).to_pylist() for c in ("cell", "rows", "shingles"))):
                rows = _thawed(*block)
                near, nearest, own = (rows.column(c).to_pylist() for c in ("near", "nearest", "home"))
                take = np.repeat(np.arange(rows.num_rows), [len(q) for q in near])
                out = rows.select(["key", "n", "copies", "shingles"]).take(pa.array(take))
                out = out.append_column("cell", pa.array([f"{name}.{q}" for qs in near for q in qs], pa.string())).append_column(
                    "home", pa.array([bool(h) and q == first for qs, first, h in zip(near, nearest, own) for q in qs], pa.bool_()))
                yield from out.select(["cell", "key", "n", "copies", "shingles", "home"]).combine_chunks().to_batches()

    return blocks_of.select("cell", "rows", "shingles").mapInArrow(run, "cell string, key string, n long, copies long, shingles binary, home boolean")


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """The number of common shingles of every two sets of a cell."""
    m = len(sets)
    order = np.argsort(np.concatenate(sets), kind="stable")
    value = np.concatenate(sets)[order]
    owner = np.repeat(np.arange(m), [len(s) for s in sets])[order]
    starts = np.flatnonzero(np.diff(value, prepend=value[0] ^ U(1)) != 0)
    size = np.diff(np.append(starts, len(value)))
    common = np.zeros((m, m), dtype=np.float32)
    for k in range(2, 17):  # shingles of few points: their pairs one by one
        at = starts[size == k]
        for part in np.array_split(at, 1 + len(at) * k * k // (1 << 19)):
            who = owner[part[:, None] + np.arange(k)]
            code = (who[:, :, None] * m + who[:, None, :]).ravel()
            if len(code):
                common += np.bincount(code, minlength=m * m).reshape(m, m)
    many = np.flatnonzero(size > 16)
    for part in np.array_split(many, 1 + len(many) // 512):  # shingles of many: rows of 0 and 1, multiplied
        if len(part):
            has = np.zeros((m, len(part)), dtype=np.float32)
            for column, g in enumerate(part):
                has[owner[starts[g]: starts[g] + size[g]], column] = 1
            common += has @ has.T
    return common


def _compared(rows: pa.Table, side: np.ndarray | None, threshold: tuple[int, int]) -> pa.Table:
    """(key, links, root) of points that are compared, all with each other or, given sides, those of one side with those of the other. Points at home
    have the sum of the copies of what they are linked to, others 0; root: the least point they are linked to, also through others."""
    num, den = threshold
    key = np.array(rows.column("key").to_pylist(), dtype=object)
    order = np.argsort(key, kind="stable")
    key, m = key[order], len(key)
    raw = rows.column("shingles").to_pylist()
    home, copies, n = (rows.column(c).to_numpy()[order] for c in ("home", "copies", "n"))
    common, n = _common([np.frombuffer(raw[i], dtype=U) for i in order]).astype(np.float64), n.astype(np.float64)
    link = den * common >= num * (n[:, None] + n[None, :] - common)
    if side is not None:
        link &= side[order][:, None] != side[order][None, :]
    np.fill_diagonal(link, False)
    links = link @ copies
    label = np.arange(m)
    while True:
        new = np.minimum(label, np.where(link, label[None, :], m).min(axis=1, initial=m))
        new = new[new]
        if (new == label).all():
            break
        label = new
    return pa.table([pa.array(key.tolist(), pa.string()), pa.array(np.where(home, links, 0), pa.int64()), pa.array(key[label].tolist(), pa.string())],
                    names=["key", "links", "root"])


def _join_cell(threshold: tuple[int, int]):
    def run(table: pa.Table) -> pa.Table:
        return _compared(table, None, threshold)

    return run


def _join_blocks(threshold: tuple[int, int]):
    """Two blocks of a cell, or one with itself."""
    def run(table: pa.Table) -> pa.Table:
        parts = [_thawed(*x) for x in zip(table.column("rows").to_pylist(), table.column("shingles").to_pylist())]
        itself = table.column("first")[0] == table.column("second")[0]
        return _compared(pa.concat_tables(parts), None if itself else np.repeat(np.arange(len(parts)), [p.num_rows for p in parts]), threshold)

    return run


def _joined(points: DataFrame, threshold: tuple[int, int], stage) -> DataFrame:
    """(key, links, root) of every cell; points: cell, key, n, copies, shingles."""
    radius, found = 1 - threshold[0] / threshold[1], "key string, links long, root string"
    cells = stage(points.withColumn("home", F.lit(True)))
    done, dealt = [], []
    for depth in range(MAX_DEPTH + 1):
        stats = cells.groupBy("cell").agg(F.count("*").alias("points"), F.sum("n").alias("shingles_"))
        fill = F.greatest(F.col("points") / CELL_POINTS, F.col("shingles_") / CELL_SHINGLES)
        big = stage(stats.filter(fill > 1).withColumn("blocks_", F.ceil(2 * fill).cast("int")))
        small = cells.join(big.select("cell"), "cell", "left_anti")
        done.append(small.select("cell", "key", "n", "copies", "shingles", "home"))
        if big.isEmpty():
            break
        made = _blocks(cells, big, radius, stage)
        of_pivot = made.select("cell", F.posexplode("in_cell").alias("pivot", "in_cell")).groupBy("cell", "pivot").agg(F.sum("in_cell").alias("in_cell"))
        pays = F.sum(F.pow("in_cell", F.lit(2))) * 2 <= F.pow(F.any_value("points"), F.lit(2))
        splits = stage(of_pivot.join(big.select("cell", "points"), "cell").groupBy("cell").agg((pays & F.lit(depth < MAX_DEPTH)).alias("splits")))
        other = F.explode(F.sequence(F.lit(0), F.col("blocks_") - 1)).alias("other")
        dealt.append(made.join(splits.filter(~F.col("splits")), "cell", "left_semi").select("cell", "block", "rows", "shingles", other).select(
            "cell", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), "rows", "shingles"))
        if splits.filter("splits").isEmpty():
            break
        cells = stage(_split(made.join(splits.filter("splits"), "cell", "left_semi")))

    def all_of(parts):
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        return every

    out = all_of(done).groupBy("cell").applyInArrow(_join_cell(threshold), found)
    if dealt:
        out = out.unionByName(all_of(dealt).groupBy("cell", "first", "second").applyInArrow(_join_blocks(threshold), found))
    return stage(out)


def jaccard_links(docs: DataFrame, *, words: int = WORDS, threshold: tuple[int, int] = THRESHOLD, block_bytes: int = blocks.BLOCK_BYTES,
                  bucket_keys: int = blocks.BUCKET_KEYS) -> DataFrame:
    """One row per document (doc_id, text): doc_id, n_shingles, component_id, n_links, set_key, is_first.

    n_links counts the other documents within the threshold, copies included. component_id is the smallest doc_id of the
    connected component; a null doc_id counts only where a component has no other. is_first marks one set and doc_id per component.
    Documents without words (null and empty texts) have no set: setset_key_ is null, component_id their own doc_id, n_links 0, is_first
    true. Repeated rows are copies of each other, also under one doc_id. An empty table gives an empty result.
    """
    spark: SparkSession = docs.sparkSession
    kept = staging(spark, frees=True)
    total = blocks.text_bytes(docs)
    n_blocks, n_buckets = blocks.block_count(total, block_bytes), max(1, -(-total // (6 * bucket_keys)))
    with staging(spark, frees=True) as stage:
        points = _keyed(docs, words, ["text"], True)
        candidates = stage(_candidates(points, words, threshold, n_blocks, n_buckets))
        members = kept(_keyed(docs, words, ["doc_id"], False))
        sets = members.filter("set_key_ is not null").groupBy(F.col("set_key_").alias("key")).agg(F.count("*").alias("copies"), F.min("doc_id").alias("least"))
        regions = _regions(candidates, stage)
        cells = candidates.join(regions, candidates.key == regions.v).join(sets.select("key", "copies"), "key").select(
            F.col("root").alias("cell"), "key", "n", "copies", "shingles")
        found = _joined(cells, threshold, stage)
        roots = components(found.select(F.col("key").alias("a"), F.col("root").alias("b")), stage)
        links = found.groupBy("key").agg(F.sum("links").alias("links"))
        labelled = kept(sets.join(roots, sets.key == roots.v, "left").join(links, "key", "left").select(
            "key", "copies", "least", F.coalesce("root", "key").alias("root"), F.coalesce("links", F.lit(0)).alias("links")))
    # the first member: least doc_id, nulls last, then least key
    order = F.struct(F.col("least").isNull().alias("no_id"), "least", "key")
    heads = labelled.groupBy("root").agg(F.min(order).alias("head"))
    labelled = labelled.join(heads, "root").select(
        "key", (F.col("links") + F.col("copies") - 1).alias("links"), F.col("head.least").alias("component"), (F.col("head.key") == F.col("key")).alias("head"))
    full = members.filter("set_key_ is not null").join(labelled, F.col("set_key_") == F.col("key")).select(
        "doc_id", F.col("n_").alias("n_shingles"), F.col("component").alias("component_id"), F.col("links").alias("n_links"), F.col("key").alias("set_key"),
        (F.col("head") & F.col("doc_id").eqNullSafe(F.col("component"))).alias("is_first"))
    empty = members.filter("set_key_ is null").select(
        "doc_id", F.col("n_").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"),
        F.lit(None).cast("string").alias("set_key"), F.lit(True).alias("is_first"))
    return full.unionByName(empty)


def one_per_group(docs: DataFrame, *, words: int = WORDS, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """The rows of `docs`, with all their columns, that are first in their component; of repeated rows one. Rows without words all stay."""
    columns = docs.columns
    links = jaccard_links(docs, words=words, threshold=threshold)
    heads = links.filter("is_first and set_key is not null").select(F.col("set_key").alias("head_"), F.col("doc_id").alias("id_")).distinct()
    keyed = _keyed(docs, words, columns, False)
    # rows are shuffled once, by one number, for the join and to find repeated ones; heads are distinct (a semi join would be pushed below the shuffle)
    rows = keyed.filter("set_key_ is not null").withColumn("row_at_", F.xxhash64("set_key_", "doc_id")).repartition("row_at_")
    heads = heads.withColumn("head_at_", F.xxhash64("head_", "id_"))
    chosen = rows.join(heads, (F.col("row_at_") == F.col("head_at_")) & (F.col("set_key_") == F.col("head_")) & F.col("doc_id").eqNullSafe(F.col("id_"))
                       ).dropDuplicates(["row_at_", "set_key_", "doc_id"])
    return chosen.select(*columns).unionByName(keyed.filter("set_key_ is null").select(*columns))
