"""High-water marks and changed groups."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators.merge import insert_ignore
from orderloom.operators.relational import keep_keys, union_all

START = datetime(1970, 1, 1)
LOG_SCHEMA = T.StructType([
    T.StructField("dwtable_name", T.StringType()),
    T.StructField("updatetime", T.TimestampNTZType()),
])


def empty_log(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LOG_SCHEMA)


def watermarks(log: DataFrame, default: datetime = START) -> dict[str, datetime]:
    """Highest logged time per table: one small row per table name, read once.

    As plain values they reach the scan as pushed filters, which a subquery would not.
    """
    marks = {r[0]: r[1] for r in log.groupBy("dwtable_name").agg(F.max("updatetime")).collect() if r[1]}
    return _Default(default, marks)


class _Default(dict):
    """A dict that answers unknown names with one value."""

    def __init__(self, default, marks):
        super().__init__(marks)
        self.default = default

    def __missing__(self, _):
        return self.default


def since(df: DataFrame, mark: datetime, col: str = "dw_updatedat") -> DataFrame:
    """Rows stamped after the mark."""
    return df.filter(F.col(col) > F.lit(mark).cast("timestamp_ntz"))


def since_each(df: DataFrame, name_col: str, marks: dict[str, datetime], col: str = "dw_updatedat") -> DataFrame:
    """Rows after the mark of the feed they belong to, all feeds in one scan."""
    name, stamped = F.col(name_col), F.col(col)

    def after(mark: datetime) -> Column:
        return stamped > F.lit(mark).cast("timestamp_ntz")

    # A disjunction of plain comparisons, feed by feed: the scan prunes by each feed's own mark.
    rest = after(getattr(marks, "default", START))
    if marks:
        rest = (name.isNull() | ~name.isin(*marks)) & rest
    return df.filter(reduce(or_, [(name == feed) & after(at) for feed, at in marks.items()], rest))


def changed_groups(df: DataFrame, keys: list[str], mark: datetime, stamp_col: str = "dw_updatedat",
                   also: DataFrame | None = None) -> DataFrame:
    """All rows of groups that have at least one row after the mark, or whose key is in `also`."""
    touched = since(df, mark, stamp_col).select(*keys)
    if also is not None:
        touched = touched.union(also.select(*keys))
    return keep_keys(df, touched, keys)


def advance(log: DataFrame, tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """The log with the highest stamp of every table; a table without rows adds nothing."""
    marks = union_all(*[
        df.agg(F.max(col).alias("updatetime")).select(F.lit(name).alias("dwtable_name"), "updatetime")
        for name, (df, col) in tables.items()
    ])
    return insert_ignore(log, marks, ["dwtable_name", "updatetime"])


def advance_each(log: DataFrame, df: DataFrame, name_col: str, col: str) -> DataFrame:
    """As advance, for several feeds held in one frame."""
    marks = df.groupBy(F.col(name_col).alias("dwtable_name")).agg(F.max(col).alias("updatetime"))
    return insert_ignore(log, marks, ["dwtable_name", "updatetime"])


def gated(gate: Column, new: dict[str, Column]) -> dict[str, Column]:
    """Recompute columns only where the gate holds; other rows keep what they have."""
    return {name: F.when(gate, value).otherwise(F.col(name)) for name, value in new.items()}


def stamp(df: DataFrame, run_ts: datetime, col: str = "dw_updatedat") -> DataFrame:
    """One stamp for all rows of a run."""
    return df.withColumn(col, F.lit(run_ts).cast("timestamp_ntz"))
