"""Which landed files each source was loaded from, so that files without news are not read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILES = "path STRING, length BIGINT, modified TIMESTAMP"
KEYS = ["path", "length", "modified"]
NO_PATHS = ("account", "shop", "minimum", "tokens")


def paths_of(source: dict) -> list[str]:
    """All paths a source names."""
    out: list[str] = []
    for name, value in source.items():
        if name not in NO_PATHS and value:
            out += value if isinstance(value, list) else value.values() if isinstance(value, dict) else [value]
    return out


def listed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The files under some paths with their size and time; contents are not read."""
    files = spark.read.format("binaryFile").load(paths)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


class Manifest:
    """Files loaded so far, under the folder of a store; a row per file and version of it."""

    def __init__(self, spark: SparkSession, root: str, feed: str, source: str):
        self.spark, self.path = spark, f"{root}/_files/feed={feed}/source={source}"

    def _loaded(self) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], FILES)
        return self.spark.read.schema(FILES).parquet(self.path)

    def fresh(self, paths: list[str]) -> DataFrame:
        """Files that are new or changed since they were loaded."""
        return listed(self.spark, paths).join(self._loaded(), KEYS, "left_anti")

    def add(self, files: DataFrame) -> None:
        files.select(*KEYS).coalesce(1).write.mode("append").parquet(self.path)  # a short row per file
