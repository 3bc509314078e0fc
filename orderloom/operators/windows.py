"""Row-order operators: fill-down, runs, even splits, latest and first per key, duplicates (W, A16).

Sheets carry a `row_no`. Cutting it into blocks bounds the rows a task sorts, whatever the share of
one sheet: windows run inside a block, and one summary row per block carries values across.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.operators.relational import join_back

BLOCK_ROWS = 100_000


def _block(row_no: str, block_rows: int) -> Column:
    return F.floor(F.col(row_no) / F.lit(block_rows)).cast("bigint")


def _partition(by) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def fill_down(df: DataFrame, cols: list[str], by, row_no: str = "row_no", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Replace NULL by the last value above it in the same sheet."""
    by = _partition(by)
    names = df.columns
    blocked = df.withColumn("__block", _block(row_no, block_rows))
    tails = blocked.groupBy(*by, "__block").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(row_no))).alias("__t_" + c) for c in cols]
    )
    above = Window.partitionBy(*by).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    carry = tails.select(*by, "__block", *[F.last("__t_" + c, ignorenulls=True).over(above).alias("__c_" + c) for c in cols])
    inside = Window.partitionBy(*by, "__block").orderBy(row_no).rowsBetween(Window.unboundedPreceding, 0)
    local = blocked.withColumns({c: F.last(c, ignorenulls=True).over(inside) for c in cols})
    joined = local.join(carry, [*by, "__block"], "left")
    return joined.select(*[F.coalesce(c, "__c_" + c).alias(c) if c in cols else F.col(c) for c in names])


def runs(df: DataFrame, col: str, by, row_no: str = "row_no", out: str = "run_id",
         block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Number the stretches of equal neighbours in a sheet; a NULL is a stretch of its own."""
    by = _partition(by)
    names = df.columns
    blocked = df.withColumn("__block", _block(row_no, block_rows))
    inside = Window.partitionBy(*by, "__block").orderBy(row_no)
    blocked = blocked.withColumns({"__pos": F.row_number().over(inside), "__prev": F.lag(col).over(inside)})
    # A new run starts at every change; for the first row of a block the block before decides.
    starts = F.when(F.col("__pos") == 1, F.lit(0)).otherwise(
        F.coalesce(F.col(col) != F.col("__prev"), F.lit(True)).cast("int")
    )
    blocked = blocked.withColumn("__step", F.sum(starts).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    edges = blocked.groupBy(*by, "__block").agg(
        F.max("__step").alias("__steps"),
        F.min_by(F.struct(F.col(col).alias("v")), row_no)["v"].alias("__first"),
        F.max_by(F.struct(F.col(col).alias("v")), row_no)["v"].alias("__last"),
    )
    order = Window.partitionBy(*by).orderBy("__block")
    opens = F.coalesce(F.col("__first") != F.lag("__last").over(order), F.lit(True)).cast("int")
    edges = edges.withColumn("__opens", opens)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    edges = edges.select(
        *by, "__block", (F.sum(F.col("__steps") + F.col("__opens")).over(upto) - F.col("__steps")).alias("__base")
    )
    joined = blocked.join(edges, [*by, "__block"], "left")
    return joined.select(*names, (F.col("__base") + F.col("__step")).cast("bigint").alias(out))


def split_even(df: DataFrame, col: str, by, row_no: str = "row_no", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Divide a value by the length of the run of equal neighbours it stands in."""
    by = _partition(by)
    names = df.columns
    numbered = runs(df, col, by, row_no, "__run", block_rows)
    joined = with_group_size(numbered, [*by, "__run"], "__size")
    return joined.select(*[(F.col(c) / F.col("__size")).alias(c) if c == col else F.col(c) for c in names])


def latest_per_key(df: DataFrame, keys, order: list[Column]) -> DataFrame:
    """The last row per key in the given ascending order.

    Catalyst limits each key to one row on the map side before the shuffle, so hot keys stay small.
    """
    return _one_per_key(df, keys, [c.desc_nulls_last() for c in order])


def first_per_key(df: DataFrame, keys, order: list[Column]) -> DataFrame:
    """The first row per key in the given ascending order."""
    return _one_per_key(df, keys, [c.asc_nulls_last() for c in order])


def _one_per_key(df: DataFrame, keys, order: list[Column]) -> DataFrame:
    window = Window.partitionBy(*_partition(keys)).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


def duplicates(df: DataFrame, keys) -> DataFrame:
    """All members of groups with more than one row; NULL keys form a group."""
    keys = _partition(keys)
    repeated = df.groupBy(*[F.col(k).alias("__k_" + k) for k in keys]).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col("__k_" + k)) for k in keys])
    return df.join(repeated, same, "left_semi")


def with_group_size(df: DataFrame, keys, out: str) -> DataFrame:
    """Every row with the number of rows in its group."""
    keys = _partition(keys)
    return join_back(df, df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)), keys)
