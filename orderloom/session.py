"""Session settings the operators rely on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Hot keys are split by the adaptive skew join, also where the split costs one more
# exchange, because a third of all rows may carry one key.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows that lie by one key of a join are not shuffled by all of its keys; the other side follows them.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Switch on the adaptive features the operators count on; leave all else as set."""
    for key, value in ADAPTIVE.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


INPUT_PER_TASK = 4 << 20  # bytes of Parquet; rows in a sort take several times as much


def spread(spark: SparkSession, paths: list[str]) -> None:
    """Have shuffles begin with as many partitions as the files under the paths are large, at least as many as are set.

    A fixed number would let partitions grow with the input until their sorts spill. Adaptive execution joins partitions that turn out small.
    """
    conf, size = spark._jsc.hadoopConfiguration(), 0
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        size += path.getFileSystem(conf).getContentSummary(path).getLength()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // INPUT_PER_TASK))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", parts)


def local_session(app: str = "orderloom", cores: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and the bench. On a cluster, pass your own session to the operators."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", os.cpu_count() or 8)
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
