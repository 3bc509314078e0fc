"""K-means on integer vectors by equal-average equal-variance nearest-centroid search.

Centroids are sorted by the sum of their components. A vector's search starts where its own sum belongs and goes outward, the side with the
nearer sum first. For sums S and squared lengths Q of n components, the squared distance to a centroid is at least
((S - S')^2 + (sqrt(n Q - S^2) - sqrt(n Q' - S'^2))^2) / n. If the first term alone exceeds the best distance, the search is over, as all
further centroids are farther by it; if both exceed it, that centroid is rejected; else its distance is computed, in integers.
Bounds are taken a little smaller than floating point gives them, so that they reject no centroid at the same distance.

Vectors are read once and kept as integers; each round is one pass that leaves one row of sums per task and cluster, of which only
centroids * components totals come to the driver. The centroids are sent along with the code: both are bounded by k and the width.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.tables import staging
from orderloom.llm.vectors import components, finite, matrix

CENTROIDS = 16
ROUNDS = 3
WIDTH = 64
SCALE = 64
SEED = "1"


class Centroids:
    """Centroids in the order of their sums, to be searched outward from a vector's own sum."""

    def __init__(self, centroids: np.ndarray):
        self.width = centroids.shape[1]
        sums = centroids.sum(axis=1)
        self.number = np.argsort(sums, kind="stable")
        self.rows, self.sums = centroids[self.number], sums[self.number]
        self.spread = self._spread(self.rows, self.sums)

    def _spread(self, rows: np.ndarray, sums: np.ndarray) -> np.ndarray:
        return np.sqrt((self.width * np.einsum("ij,ij->i", rows, rows) - sums * sums).astype(float))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each row's nearest centroid (ties: the smaller number) and the squared distance."""
        k, far = len(self.rows), np.iinfo(np.int64).max
        sums = x.sum(axis=1)
        spread = self._spread(x, sums)
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        best, who = np.full(len(x), far), np.full(len(x), k)
        active = np.arange(len(x))
        while len(active):
            s, lo, hi = sums[active], left[active], right[active]
            below = np.where(lo >= 0, s - self.sums[np.maximum(lo, 0)], far)
            above = np.where(hi < k, self.sums[np.minimum(hi, k - 1)] - s, far)
            gap = np.minimum(below, above)
            going = (gap < far) & (gap.astype(float) ** 2 * (1 - 1e-12) <= best[active].astype(float) * self.width)
            active, lo, hi, gap, down = active[going], lo[going], hi[going], gap[going].astype(float), (below <= above)[going]
            at = np.where(down, lo, hi)
            left[active[down]] -= 1
            right[active[~down]] += 1
            apart = np.abs(spread[active] - self.spread[at])
            apart = np.maximum(0, apart - 1e-14 * (spread[active] + self.spread[at]))
            near = (gap**2 + apart**2) * (1 - 1e-12) <= best[active].astype(float) * self.width
            for c in np.unique(at[near]):
                rows = active[near & (at == c)]
                apart = x[rows] - self.rows[c]
                distance = np.einsum("ij,ij->i", apart, apart)
                better = (distance < best[rows]) | ((distance == best[rows]) & (self.number[c] < who[rows]))
                best[rows[better]], who[rows[better]] = distance[better], self.number[c]
        return who, best


def _sums(vectors: DataFrame, centroids: np.ndarray) -> dict[int, list[int]]:
    """For each cluster that has vectors, the componentwise floor(sum / count)."""
    k, width = centroids.shape

    def run(batches):
        search, n, total = Centroids(centroids), np.zeros(k, dtype=np.int64), np.zeros((k, width), dtype=np.int64)
        for batch in batches:
            x = matrix(batch.column("v"), width)
            who, _ = search.nearest(x)
            n += np.bincount(who, minlength=k)
            for c in np.unique(who):
                total[c] += x[who == c].sum(axis=0)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some]), pa.array(list(total[some]), pa.list_(pa.int64()))], names=["cluster", "n", "total"])

    of_tasks = vectors.select("v").mapInArrow(run, "cluster int, n long, total array<long>")
    of_tasks = of_tasks.select("cluster", "n", F.posexplode("total").alias("at", "part"))
    whole = of_tasks.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()  # k * width rows
    out: dict[int, list[int]] = {}
    for r in whole:
        out.setdefault(r.cluster, [0] * width)[r["at"]] = int(r.total) // r.n
    return out


def clusters(vectors: DataFrame, *, k: int = CENTROIDS, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE, seed: str = SEED) -> DataFrame:
    """One row per kept row of `vectors` (vec_id, embedding): vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    Kept are vectors of exactly `width` components, none null or not finite; null vectors are not kept. A component is floor(scale * x), which
    is held within 2**31 / width so that all sums of squares are exact (33 million at 64 components). The centroids start as the k vectors
    with the smallest SHA-256 of "seed:vec_id"; repeated ids are taken in the order of their components, null ids last and in the same order. With
    fewer vectors there are fewer centroids, and none without vectors, which gives an empty result. Repeated rows count as often as they
    stand there. Other columns are not read.
    """
    spark = vectors.sparkSession
    whole = vectors.filter((F.size("embedding") == width) & finite(F.col("embedding")))
    with staging(spark) as stage:
        kept = stage(whole.select("vec_id", components(F.col("embedding"), scale, (1 << 31) // width).alias("v")))
        order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
        first = kept.orderBy(order.asc_nulls_last(), "v").limit(k).select("v").collect()  # k rows
        centroids = np.array([r.v for r in first], dtype=np.int64).reshape(len(first), width)
        if not len(first):
            return spark.createDataFrame([], f"vec_id {kept.schema['vec_id'].dataType.simpleString()}, {RESULT}")
        for _ in range(rounds):
            for c, total in _sums(kept, centroids).items():
                centroids[c] = total

        def run(batches):
            search = Centroids(centroids)
            for batch in batches:
                who, distance = search.nearest(matrix(batch.column("v"), width))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(who.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

        dealt = staging(spark)(kept.mapInArrow(run, f"vec_id {kept.schema['vec_id'].dataType.simpleString()}, cluster int, distance long"))
    inertia = {r.cluster: r.total for r in dealt.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}  # k rows
    totals = [(c, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c in sorted(inertia)]
    return dealt.join(F.broadcast(spark.createDataFrame(totals, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


RESULT = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
