"""Data-quality policies (QA-QI, A17): fail, warn, drop, coerce, fall back, gate, reject files, check contracts."""

from __future__ import annotations

import re
import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityError(ValueError):
    """Input that must not be loaded."""


def violations(df: DataFrame, checks: dict[str, Column]) -> dict[str, int]:
    """Rows per named condition, all counted in one pass."""
    if not checks:
        return {}
    return df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()]).first().asDict()


def fail_rows(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Stop if any row meets one of the named bad conditions: the query itself fails on the first one."""
    for name, bad in checks.items():
        df = df.filter(
            F.when(F.coalesce(bad, F.lit(False)), F.raise_error(F.lit(f"must not be loaded: {name}")).cast("boolean"))
            .otherwise(F.lit(True))
        )
    return df


def expect_or_drop(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected)."""
    ok = F.coalesce(ok, F.lit(False))
    return df.filter(ok), df.filter(~ok)


def coerce(col: Column, type_name: str = "bigint", default=0) -> Column:
    """What does not parse becomes the default (None: NULL)."""
    value = col.try_cast(type_name)
    return value if default is None else F.coalesce(value, F.lit(default))


def flag_files(df: DataFrame, bad: Column, file_col: str = "source_file") -> DataFrame:
    """Files with at least one bad row."""
    return df.filter(F.coalesce(bad, F.lit(False))).select(file_col).distinct()


def fallback_per_file(df: DataFrame, col: str, bad: Column, value: Column, file_col: str = "source_file") -> DataFrame:
    """Where one row of a file is bad, all rows of that file take the fallback value."""
    files = flag_files(df, bad, file_col).select(F.col(file_col).alias("__file"), F.lit(True).alias("__bad"))
    joined = df.join(files, F.col(file_col).eqNullSafe(F.col("__file")), "left")
    return joined.select(*[F.when(F.col("__bad"), value).otherwise(F.col(c)).alias(c) if c == col else c
                           for c in df.columns])


def enough(counts: dict[str, int], minimum: int) -> bool:
    """Whether every count reaches the minimum; reported if not."""
    short = {n: c for n, c in counts.items() if c < minimum}
    if short:
        warnings.warn(f"nothing loaded, fewer than {minimum} valid rows: {short}", stacklevel=3)
    return not short


def volume_gate(df: DataFrame, checks: dict[str, Column], minimum: int) -> DataFrame:
    """All rows if every condition holds often enough, otherwise none."""
    return df if enough(violations(df, checks), minimum) else df.filter(F.lit(False))


def assert_not_null(df: DataFrame, cols: list[str]) -> None:
    bad = {n: c for n, c in violations(df, {c: F.col(c).isNull() for c in cols}).items() if c}
    if bad:
        raise QualityError(f"missing values: {bad}")


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def assert_pk(df: DataFrame, keys: list[str]) -> None:
    assert_not_null(df, keys)
    n = repeated_keys(df, keys).count()
    if n:
        raise QualityError(f"{n} repeated keys {keys}")


def dangling(df: DataFrame, col: str, dim: DataFrame, key: str) -> DataFrame:
    """Rows whose reference is set but not in the dimension."""
    known = dim.select(F.col(key).alias("__key"))
    return df.filter(F.col(col).isNotNull()).join(known, F.col(col) == F.col("__key"), "left_anti")


def assert_fk(df: DataFrame, col: str, dim: DataFrame, key: str) -> None:
    n = dangling(df, col, dim, key).count()
    if n:
        raise QualityError(f"{n} rows with {col} not in {key}")


def assert_select(sql: str) -> str:
    """Only plain queries may run as reports."""
    body = re.sub(r"--[^\n]*|/\*.*?\*/", " ", sql, flags=re.S).strip()
    if not re.match(r"(?i)(select|with)\b", body):
        raise QualityError("a report must be a SELECT statement")
    return sql
