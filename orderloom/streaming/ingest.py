"""Landed files as a stream of batches (C7): each file is read once, each batch merged once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orderloom.staged import Staged

DONE = "batch BIGINT"


def merged_once(spark: SparkSession, merge: Callable[[DataFrame, int], None], ledger: str) -> Callable[[DataFrame, int], None]:
    """`merge` for batches that may come again: the rows are written aside once, whatever reads them how often, and a
    batch whose number stands in the ledger is left alone. A run that dies before that repeats the merge, which has to give the same table again."""

    def done() -> bool:
        path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
        return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)

    def once(rows: DataFrame, number: int) -> None:
        if done() and not spark.read.schema(DONE).parquet(ledger).filter(F.col("batch") == number).isEmpty():
            return
        with Staged(spark) as stage:
            merge(stage(rows), number)
        spark.createDataFrame([(number,)], DONE).coalesce(1).write.mode("append").parquet(ledger)

    return once


def ingest_available(
    spark: SparkSession, src: str, schema: T.StructType, merge: Callable[[DataFrame, int], None], checkpoint: str, *,
    fmt: str = "csv", options: dict | None = None, files_per_batch: int | None = None,
) -> StreamingQuery:
    """Hand all files that have arrived since the last call to `merge`, then stop.

    merge       called with (rows, batch number); rows carry source_file. A batch that fails is repeated, so merge
                must give the same table again, as the keyed merges do
    checkpoint  folder on shared storage that remembers which files are done; beside it, with -batches behind its name, the numbers of
                the batches that were merged
    """
    reader = spark.readStream.schema(schema).format(fmt).options(**(options or {}))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.load(src).withColumn("source_file", F.lower(F.col("_metadata.file_path")))
    query = (
        rows.writeStream.foreachBatch(merged_once(spark, merge, f"{checkpoint}-batches")).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query
