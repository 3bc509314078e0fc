"""Predicates and rule columns."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def rule_cascade(rules: list[tuple[Column, object]], default=None) -> Column:
    """The value of the first rule that holds, else the default."""
    (first, value), *rest = rules
    out = F.when(first, value)
    for condition, value in rest:
        out = out.when(condition, value)
    return out.otherwise(default)


def is_not(col: Column, value) -> Column:
    """Not equal, where NULL counts as different."""
    return ~col.eqNullSafe(F.lit(value))


def not_in(col: Column, values) -> Column:
    """SQL NOT IN: NULL is neither in nor out."""
    return ~col.isin(list(values))


def differs(left: list[Column], right: list[Column]) -> Column:
    """Whether any pair differs, NULL equal to NULL."""
    return reduce(or_, [~a.eqNullSafe(b) for a, b in zip(left, right, strict=True)], F.lit(False))


def overwrite_where(old: Column, condition: Column, value) -> Column:
    return F.when(condition, value).otherwise(old)


def out_of_range(col: Column, low, high) -> Column:
    """Above the ceiling, or below the floor and not 0."""
    return ((col < low) & (col != 0)) | (col > high)
