"""Reading the shared tables and writing intermediate results where all executors see them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.session import tune
from orderloom.staged import Staged


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def staging(spark: SparkSession, frees: bool = False) -> Staged:
    """Writes intermediate tables under spark.checkpoint.dir; a lost executor then costs a read, not a recomputation."""
    return Staged(tune(spark), frees)


BROADCAST_ROWS = 1_000_000  # of narrow rows: some 10 MB


def joinable(df: DataFrame, stage: Staged, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A narrow table, written aside and counted: to be broadcast up to `rows` rows, joined by a shuffle beyond."""
    kept = stage(df)
    return F.broadcast(kept) if kept.count() <= rows else kept
