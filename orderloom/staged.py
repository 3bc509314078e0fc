"""Intermediate results that several later steps read, written once to the shared checkpoint folder.

This cuts lineage: a lost executor costs a read of the written table, not a recomputation of all before it,
and each later step reads only the columns it needs.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="orderloom-")


def staging_root(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; a temporary one only for local sessions."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_root()


FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Staged:
    """Writes intermediate tables; as a context manager it drops them at the end, also after an error.

    frees: what a table's making has shuffled is removed once the table stands, not when the driver happens to collect its garbage.
    """

    def __init__(self, spark: SparkSession, frees: bool = False):
        self.spark = spark
        self.frees = frees
        self.root = f"{staging_root(spark)}/staged-{uuid.uuid4().hex}"
        self.count = 0

    def __call__(self, df: DataFrame, by: str | None = None) -> DataFrame:
        """The rows, read from where they were written; by: a column to part them by."""
        path = f"{self.root}/{self.count}"
        self.count += 1
        before = self.spark.conf.get(FREES_SHUFFLES, None)
        if self.frees:
            self.spark.conf.set(FREES_SHUFFLES, "true")
        try:
            (df.write.partitionBy(by) if by else df.write).parquet(path)
        finally:
            if self.frees:
                self.spark.conf.unset(FREES_SHUFFLES) if before is None else self.spark.conf.set(FREES_SHUFFLES, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Staged:
        return self

    def __exit__(self, *_) -> None:
        self.drop()

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
