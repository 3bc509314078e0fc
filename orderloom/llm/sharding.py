"""Shards by jump consistent hashing: a key and the number of shards decide, without a ring table.

One more shard takes rows only into itself, 1 in n + 1 of them. Slots number the rows of a shard without gaps: rows are sorted by shard and
id across range partitions, each partition numbers its own, and the partitions' counts (a row per partition and shard) give the offsets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from orderloom.llm.tables import staging

SHARDS = 8
NEW = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
U = np.uint64


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key (Lamping and Veach, 2014), for all keys at once."""
    state = keys.astype(U).copy()
    at = np.full(len(state), -1, dtype=np.int64)
    ahead = np.zeros(len(state), dtype=np.int64)
    moving = np.flatnonzero(ahead < shards)
    while len(moving):
        at[moving] = ahead[moving]
        state[moving] = state[moving] * U(2862933555777941757) + U(1)
        ahead[moving] = ((at[moving] + 1) * (2.0**31 / ((state[moving] >> U(33)).astype(np.float64) + 1))).astype(np.int64)
        moving = moving[ahead[moving] < shards]
    return at


def with_shards(df: DataFrame, key: Column, counts: dict[str, int]) -> DataFrame:
    """df with a column per entry of counts: the shard of `key` (a 64-bit number) among that many."""
    names = list(counts)

    def run(batches):
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index("jump_key_")).to_numpy(zero_copy_only=False).view(U)
            rest = [c for c in batch.schema.names if c != "jump_key_"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), *(pa.array(jump(keys, counts[n]).astype(np.int32)) for n in names)],
                                             names=[*rest, *names])

    types = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), *(f"{n} int" for n in names)])
    return df.withColumn("jump_key_", key).mapInArrow(run, types)


def shards(docs: DataFrame, carry: list[str] | None = None, *, n_shards: int = SHARDS) -> DataFrame:
    """Columns `carry` (doc_id if none are named) with size, text_crc32, law ("key"), shard, slot, grown_shard.

    The key is the doc_id; null ids go to one shard. size: UTF-8 bytes of the text and 1, null texts count as empty. Rows with equal ids share
    a shard. Slots follow doc_id, text_crc32, size; rows equal in these are numbered in any order. An empty table gives an empty result.
    A column of `carry` that has the name of a new one is replaced by it.
    """
    carry = [c for c in (["doc_id"] if carry is None else carry) if c not in NEW]
    stage = staging(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    named = docs.select(*carry, *([] if "doc_id" in carry else ["doc_id"]), (F.octet_length(text) + 1).cast("long").alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    placed = with_shards(named, F.xxhash64("doc_id"), {"shard": n_shards, "grown_shard": n_shards + 1})
    order = ["shard", "doc_id", "text_crc32", "size"]
    # the draw lets rows that are equal in all else be parted
    sorted_ = placed.withColumn("draw_", F.rand(7)).repartitionByRange(*order, "draw_").sortWithinPartitions(*order, "draw_").drop("draw_")
    kept = stage(sorted_.withColumn("part_", F.spark_partition_id()).withColumn("at_", F.monotonically_increasing_id()))
    counts = kept.groupBy("shard", "part_").agg(F.min("at_").alias("first_"), F.count("*").alias("n_"))
    before = F.sum("n_").over(Window.partitionBy("shard").orderBy("part_").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.withColumn("before_", F.coalesce(before, F.lit(0))).drop("n_")
    # a row per partition and shard that it holds: partitions + shards - 1 rows at most
    return kept.join(F.broadcast(offsets), ["shard", "part_"]).select(
        *carry, "size", "text_crc32", "law", "shard", (F.col("at_") - F.col("first_") + F.col("before_")).alias("slot"), "grown_shard")
