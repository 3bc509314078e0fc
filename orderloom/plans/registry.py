"""Named queries over the shared tables, each with the plain SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderloom.session import spread, tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
SCHEMAS: dict[str, StructType] = {}


class Tables:
    """The shared tables of one directory as DataFrames: tables('orders') or tables.orders."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = tune(spark), path

    def __call__(self, name: str) -> DataFrame:
        path = f"{self.path}/{name}.parquet"
        if path not in SCHEMAS:  # looked up once, so that later reads start without a footer job
            SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(SCHEMAS[path]).parquet(path)

    __getattr__ = __call__

    def spread(self, *names: str) -> None:
        """Shuffle partitions by the size of some of the tables."""
        spread(self.spark, [f"{self.path}/{name}.parquet" for name in names])


def query(sql: str | None = None):
    """Register a function of Tables under its own name."""

    def register(fn):
        QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def whole(col: str | Column) -> Column:
    """A number that is not negative, rounded to the nearest whole one; stays in generated code, unlike round()."""
    return F.floor((F.col(col) if isinstance(col, str) else col) + 0.5).cast("bigint")


def cents(col: str | Column) -> Column:
    """An amount as whole cents."""
    return whole((F.col(col) if isinstance(col, str) else col) * 100)
