"""Exact search of the largest inner products by columnar branch and bound.

Vectors are packed into chunks that hold them dimension by dimension; queries are packed likewise into smaller groups. Each group meets each chunk in
a task of its own: a stated query set against all rows, in blocks, of which only the k best of each query and chunk leave the task.
In a task, scores grow one block of dimensions after the other, the dimensions with most mass first. What the dimensions that are left can still
add is at most the product of the lengths that query and candidate have in them, so a candidate whose score with that rest is below the k-th best
known score (first that of the chunk's first SEEDS rows) is out. While many are left, a block is a matrix product; once few are,
the pairs are compacted and only theirs are added up. Scores are sums of integers and exact in the floating-point type chosen for them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.tables import staging
from orderloom.llm.vectors import components, finite, padded

K = 20
SCALE = 64
LIMIT = 1 << 25  # of a component: scores of up to 8,191 components stay within 64 bits
CHUNK = 8192  # vectors of a chunk
GROUP = 2048  # queries of a group
PARTS = 4096  # partitions that chunks or groups are packed in; further ones share them
TILE = 256  # queries whose scores are held at once
SEEDS = 512
BLOCK = 16  # dimensions
FEW = 0.15  # share of pairs left from which they are compacted


def _exact(dims: int, a: int, b: int):
    """The fastest type in which a sum of `dims` products of numbers up to a and b is exact."""
    most = dims * a * b
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object


def _packed(rows: DataFrame, n: int, most: int, of: str) -> tuple[DataFrame, int]:
    """Rows with n vectors in all, as rows of up to about `most` vectors dimension by dimension, numbered in column `of`, and how many numbers there are."""
    numbers = -(-n // most)
    parts = min(numbers, PARTS)
    each = -(-numbers // parts)

    def run(batches):
        held, count, made = [], 0, 0
        for batch in batches:
            for start in range(0, batch.num_rows, most):
                held.append(batch.slice(start, most))
                count += held[-1].num_rows
                if count >= most:
                    yield pack(pa.Table.from_batches(held), made % each)
                    held, count, made = [], 0, made + 1
        if held:
            yield pack(pa.Table.from_batches(held), made % each)

    def pack(table, place):
        table = table.combine_chunks()
        part = table.column("part_")[0].as_py()
        data = padded(table.column("v").combine_chunks()).T
        small = next(t for t in (np.int8, np.int16, np.int32) if not data.size or np.abs(data).max() <= np.iinfo(t).max)
        return pa.RecordBatch.from_arrays(
            [pa.array([part * each + place], pa.int64()), pa.array([table.column("id").to_pylist()], pa.list_(table.schema.field("id").type)),
             pa.array([table.column("row").to_pylist()], pa.list_(pa.int64())), pa.array([np.dtype(small).char]), pa.array([data.shape[0]], pa.int32()),
             pa.array([np.ascontiguousarray(data, dtype=small).tobytes()], pa.binary())], names=[of, "ids", "rows", "kind", "dims", "data"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.repartition(parts).withColumn("part_", F.spark_partition_id()).mapInArrow(
        run, f"{of} long, ids array<{kind}>, rows array<long>, kind string, dims int, data binary"), parts * each


def _opened(table: pa.Table):
    """(ids, rows, matrix of dimensions by vectors) of each packed row."""
    for i in range(table.num_rows):
        rows = np.array(table.column("rows")[i].as_py(), dtype=np.int64)
        data = np.frombuffer(table.column("data")[i].as_py(), dtype=table.column("kind")[i].as_py())
        yield table.column("ids")[i].values, rows, data.reshape(table.column("dims")[i].as_py(), len(rows))


def _rests(data: np.ndarray, cuts: list[int]) -> np.ndarray:
    """The length of each vector in the dimensions from each cut on, rounded up."""
    squares = data.astype(float) ** 2
    return np.array([np.sqrt(squares[c:].sum(axis=0)) for c in cuts]) * (1 + 1e-9)


def best(queries: np.ndarray, candidates: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of all pairs that may be among the k best of the query, at least these; own: the candidate that is the query itself, or -1."""
    dims = min(len(queries), len(candidates))
    queries, candidates = queries[:dims].astype(np.int64), candidates[:dims].astype(np.int64)
    order = np.argsort(-(candidates.astype(float) ** 2).sum(axis=1), kind="stable")
    kind = _exact(dims, int(np.abs(queries).max(initial=0)), int(np.abs(candidates).max(initial=0)))
    q, c = queries[order].astype(kind), candidates[order].astype(kind)
    cuts = list(range(BLOCK, dims, BLOCK)) + [dims]
    rest_q, rest_c = _rests(q, cuts), _rests(c, cuts)
    found = []
    for start in range(0, q.shape[1], TILE):
        tile = slice(start, min(start + TILE, q.shape[1]))
        width, ours = tile.stop - tile.start, own[tile]
        mine = np.flatnonzero(ours >= 0)
        floor = np.full(width, -np.inf)
        seeds = (q[:, tile].T @ c[:, :SEEDS]).astype(float)
        seeds[mine[ours[mine] < SEEDS], ours[mine[ours[mine] < SEEDS]]] = -np.inf
        if seeds.shape[1] >= k:
            floor = np.partition(seeds, seeds.shape[1] - k, axis=1)[:, seeds.shape[1] - k]
        # the last bits of a score beyond 2**53 are no part of the comparison
        floor = floor - np.where(np.isfinite(floor), np.abs(floor) * 1e-9, 0)
        score, at_q, at_c, done = np.zeros((width, c.shape[1]), dtype=kind), None, None, 0
        for b, cut in enumerate(cuts):
            if at_q is None:
                score += q[done:cut, tile].T @ c[done:cut]
                left = score + np.multiply.outer(rest_q[b, tile], rest_c[b]).astype(score.dtype if kind is not object else float) * (1 + 1e-6) >= floor[:, None]
                left[mine, ours[mine]] = False
                if cut == dims or left.mean() <= FEW:
                    at_q, at_c = np.nonzero(left)
                    score = score[at_q, at_c]
            else:
                for d in range(done, cut):
                    score += q[d, at_q + start] * c[d, at_c]
                left = score + rest_q[b, at_q + start] * rest_c[b, at_c] * (1 + 1e-6) >= floor[at_q]
                at_q, at_c, score = at_q[left], at_c[left], score[left]
            done = cut
        if not dims:  # vectors without a component
            left = np.ones((width, c.shape[1]), dtype=bool)
            left[mine, ours[mine]] = False
            at_q, at_c = np.nonzero(left)
            score = np.zeros(len(at_q))
        found.append((at_q + start, at_c, score))
    at_q, at_c, score = (np.concatenate([f[i] for f in found]) for i in range(3))
    return at_q, at_c, score.astype(np.int64)


def top_k(vectors: DataFrame, is_query: Column, *, k: int = K, scale: int = SCALE) -> DataFrame:
    """For each row of `vectors` (vec_id, embedding) that is a query, the k other rows with the largest inner product: query_id, rank, vec_id, score.

    A component is floor(scale * x), held within 2**25 (33 million). Ties go to the smaller vec_id, null ids last;
    rows with equal ids and scores are ranked one after the other. Null vectors and those with null or non-finite components take no part. Missing
    components of a shorter vector count as zeros, so empty vectors score 0. With fewer other rows there are fewer results. A repeated row is a
    query, and a candidate, as often as it stands there; it is not its own candidate, but that of its copies. Null values of is_query are false. Other
    columns are not read. An empty table, or one without queries, gives an empty result.
    """
    spark = vectors.sparkSession
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"query_row long, query_id {id_type}, row long, vec_id {id_type}, score long"
    with staging(spark) as stage:
        usable = vectors.filter(finite(F.col("embedding"))).select(
            F.col("vec_id").alias("id"), components(F.col("embedding"), scale, LIMIT).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
        rows = stage(usable.withColumn("row", F.monotonically_increasing_id()))
        n, asking = rows.agg(F.count("*"), F.count(F.when(F.col("asks"), 1))).first()
        if not asking:
            return spark.createDataFrame([], f"query_id {id_type}, rank int, vec_id {id_type}, score long")
        chunks, n_chunks = _packed(rows.drop("asks"), n, CHUNK, "chunk")
        groups, n_groups = _packed(rows.filter("asks").drop("asks"), asking, GROUP, "group")
        chunks = stage(chunks).withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_groups - 1).cast("long"))))
        groups = stage(groups).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_chunks - 1).cast("long"))))

        def search(asked: pa.Table, offered: pa.Table) -> pa.Table:
            out = []
            for query_ids, query_rows, q in _opened(asked):
                for ids, rows, c in _opened(offered):
                    place = np.argsort(rows)
                    at = np.minimum(np.searchsorted(rows[place], query_rows), len(rows) - 1)
                    own = np.where(rows[place[at]] == query_rows, place[at], -1)
                    at_q, at_c, score = best(q, c, own, k)
                    # nulls last, then the smaller id
                    rank = np.empty(len(rows), dtype=np.int64)
                    rank[np.array(pc.array_sort_indices(ids, null_placement="at_end"))] = np.arange(len(rows))
                    order = np.lexsort((rank[at_c], -score, at_q))
                    at_q, at_c, score = at_q[order], at_c[order], score[order]
                    first = np.searchsorted(at_q, at_q)
                    few = np.arange(len(at_q)) - first < k
                    at_q, at_c, score = at_q[few], at_c[few], score[few]
                    out.append(pa.table({"query_row": query_rows[at_q], "query_id": query_ids.take(pa.array(at_q)), "row": rows[at_c],
                                         "vec_id": ids.take(pa.array(at_c)), "score": score}))
            kind = (asked if asked.num_rows else offered).schema.field("ids").type.value_type
            return pa.concat_tables(out) if out else pa.schema(
                {"query_row": pa.int64(), "query_id": kind, "row": pa.int64(), "vec_id": kind, "score": pa.int64()}).empty_table()

        found = staging(spark)(groups.groupBy("group", "chunk").cogroup(chunks.groupBy("group", "chunk")).applyInArrow(search, schema))
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
