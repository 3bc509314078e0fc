"""Projection, filters, lookups, deletes and unions (P, J, U)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RIGHT = "__r_"


def to_contract(df: DataFrame, mapping: dict[str, str | Column], constants: dict | None = None) -> DataFrame:
    """Project to the contract columns: output name -> input name or expression, plus constants."""
    cols = [(F.col(f"`{src}`") if isinstance(src, str) else src).alias(out) for out, src in mapping.items()]
    cols += [(v if isinstance(v, Column) else F.lit(v)).alias(out) for out, v in (constants or {}).items()]
    return df.select(*cols)


def keep_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which the predicate holds; unknown counts as not holding."""
    return df.filter(predicate)


def _prefixed(df: DataFrame, keys: dict[str, str], cols: list[str]) -> DataFrame:
    """Right side of a join, every column renamed so that no name is shared."""
    return df.select(
        *[F.col(src).alias(RIGHT + dst) for dst, src in keys.items()],
        *[F.col(c).alias(RIGHT + "v_" + c) for c in cols],
        F.lit(True).alias(RIGHT + "hit"),
    )


def _pairs(on) -> dict[str, str]:
    """on='k', on=['a', 'b'] or on={'left': 'right'} as a left -> right dict."""
    if isinstance(on, str):
        on = [on]
    return dict(on) if isinstance(on, dict) else {k: k for k in on}


def _join(df: DataFrame, other: DataFrame, on, cols: list[str], aligned: bool = False) -> DataFrame:
    keys = _pairs(on)
    return df.join(_known(_prefixed(other, keys, cols), keys), _equal(keys, aligned), "left")


def _equal(keys, aligned: bool = False) -> Column:
    """Join condition on keys whose right side is never NULL, so that NULL on the left matches nothing.

    The null-safe form does not change the result. It makes Catalyst shuffle the right side for the join itself,
    also where that is a grouped frame already partitioned by the key: adaptive execution splits a hot key only in
    joins that sit directly on their shuffles.

    aligned: the plain form, with the same result. A frame shuffled by such a key stays where it is in all further
    aligned joins, groups and windows by this key, or by it and others.
    """
    if aligned:
        return reduce(lambda a, b: a & b, [F.col(k) == F.col(RIGHT + k) for k in keys])
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(RIGHT + k)) for k in keys])


def _known(right: DataFrame, keys) -> DataFrame:
    return right.filter(reduce(lambda a, b: a & b, [F.col(RIGHT + k).isNotNull() for k in keys]))


def keep_keys(df: DataFrame, wanted: DataFrame, on, aligned: bool = False) -> DataFrame:
    """Rows whose key is among the wanted ones. aligned: see _equal."""
    keys = _pairs(on)
    right = wanted.select(*[F.col(src).alias(RIGHT + dst) for dst, src in keys.items()]).distinct()
    return df.join(_known(right, keys), _equal(keys, aligned), "left_semi")


def join_back(df: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Every row of df with the columns of its group; NULL keys form a group. `groups` holds each key once."""
    added = [c for c in groups.columns if c not in keys]
    right = groups.select(*[F.col(k).alias(RIGHT + k) for k in keys], *added)
    return df.join(right, _equal(keys), "left").select(*df.columns, *added)


def lookup(df: DataFrame, other: DataFrame, on, cols: list[str] | dict[str, str], aligned: bool = False) -> DataFrame:
    """Left join that adds columns of `other` (name -> new name). Repeated keys on the right fan out.

    The join kind is left to Catalyst: a side is broadcast only under the size threshold. aligned: see _equal.
    """
    names = cols if isinstance(cols, dict) else {c: c for c in cols}
    joined = _join(df, other, on, list(names), aligned)
    return joined.select(*df.columns, *[F.col(RIGHT + "v_" + c).alias(n) for c, n in names.items()])


def missing_members(df: DataFrame, key: Column, dim: DataFrame, dim_key: str, name: str = "member") -> DataFrame:
    """Rows whose key is not in the dimension, the key added as a column."""
    known = dim.select(F.col(dim_key).alias(RIGHT + name))
    return df.withColumn(name, key).join(_known(known, [name]), _equal([name]), "left_anti")


def update_from(
    df: DataFrame, other: DataFrame, on, rules: dict[str, Callable[[Column, Callable[[str], Column]], Column]],
    gate: Column | None = None, aligned: bool = False,
) -> DataFrame:
    """Joined update: matched rows take rules[c](old value, right-side getter), others stay.

    `other` must hold each key once; the result has the rows of `df`. aligned: see _equal.
    """
    joined = _join(df, other, on, [c for c in other.columns if c not in _pairs(on).values()], aligned)
    hit = F.col(RIGHT + "hit").isNotNull()
    if gate is not None:
        hit = hit & gate

    def right(name: str) -> Column:
        return F.col(RIGHT + "v_" + name)

    out = []
    for field in df.schema.fields:
        old = F.col(field.name)
        if field.name in rules:
            old = F.when(hit, rules[field.name](old, right)).otherwise(old).cast(field.dataType).alias(field.name)
        out.append(old)
    return joined.select(*out)


def under_owners(source: DataFrame, key: str, refs: DataFrame, col: str, owner: str) -> DataFrame:
    """Rows of a source keyed by `key` under each owner that refers to them by `col`, so that joins by owner find them.

    Short rows are shuffled by the key here, in place of the wide rows of the owners.
    """
    pairs = refs.select(F.col(owner).alias(RIGHT + "owner"), F.col(col).alias(RIGHT + "ref")).dropna().repartition(RIGHT + "ref").distinct()
    found = pairs.join(source, F.col(RIGHT + "ref") == F.col(key)).select(F.col(RIGHT + "owner").alias(owner), *source.columns)
    return found.repartition(owner)  # else joins by owner and key would have the owners' rows follow these, by key


def null_unmatched(df: DataFrame, col: str, dim: DataFrame, key: str) -> DataFrame:
    """Empty a reference that the dimension does not hold.

    Rows without a reference match nothing; a hash of the row stands for a text, so that they are dealt out over all tasks.
    """
    known = dim.select(F.col(key).alias(RIGHT + col)).distinct()
    text = df.schema[col].dataType == T.StringType()
    place = F.coalesce(col, F.xxhash64(*df.columns).cast("string")) if text else F.col(col)
    joined = df.join(_known(known, [col]), place.eqNullSafe(F.col(RIGHT + col)) & F.col(col).isNotNull(), "left")
    return joined.select(*[F.col(RIGHT + c).alias(c) if c == col else c for c in df.columns])


def delete_keys(df: DataFrame, doomed: DataFrame, on) -> DataFrame:
    """Rows whose key is not among the doomed ones."""
    keys = _pairs(on)
    gone = doomed.select(*[F.col(src).alias(RIGHT + dst) for dst, src in keys.items()])
    return df.join(_known(gone, keys), _equal(keys), "left_anti")


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """SQL DELETE: rows for which the predicate is false or unknown stay."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def map_codes(df: DataFrame, col: str, mapping: DataFrame, order: str | None = None) -> DataFrame:
    """Code to label; unmapped codes become NULL. `mapping` is (code, label[, order]).

    Where a code is listed twice, the row with the highest order wins; without an order unlike labels are an error.
    """
    code, label = [c for c in mapping.columns if c != order][:2]
    unlike = F.raise_error(F.concat(F.lit("two labels and no order for code "), F.first(code).cast("string"))).cast("string")
    only = F.when(F.min(label).eqNullSafe(F.max(label)), F.max(label)).otherwise(unlike)
    labels = mapping.groupBy(F.col(code).alias(RIGHT + col)).agg((F.max_by(label, order) if order else only).alias(RIGHT + "label"))
    joined = df.join(_known(labels, [col]), _equal([col]), "left")
    return joined.select(*[F.col(RIGHT + "label").alias(c) if c == col else c for c in df.columns])


def union_all(*frames: DataFrame) -> DataFrame:
    """Rows of all frames by column name; absent columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
