"""Keyed merges (M1-M8, M11): one pass over target and source by key, no row left to order of arrival."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.rules import differs
from orderloom.operators.relational import delete_keys

SRC, TGT = "__s_", "__t_"
MODES = ("replace", "changed", "coalesce")


def last_per_key(source: DataFrame, keys: list[str], order_col: str | None, mode: str = "replace",
                 stamp_col: str | None = None) -> DataFrame:
    """One row per key out of a batch in which a key may come several times; the last row wins. Without an
    order column the largest row wins, so that the order of arrival never decides.

    In coalesce mode the last known value of each column wins instead of the last row. Adds
    `__mixed` (changed mode: the batch holds unlike rows of the key) or `__lo_c` / `__hi_c` / `__gap_c`
    per column (coalesce mode), from which the stamp rule is decided. All of it is pre-aggregated.
    """
    cols = [c for c in source.columns if c not in keys and c != order_col]
    values = [c for c in cols if c != stamp_col]
    row = F.struct(*cols) if cols else F.struct(F.lit(True).alias("__none"))
    order = F.col(order_col) if order_col else row
    aggs = [F.max_by(row, order).alias("__row")]
    extra: list[Column] = []
    if mode == "changed" and values:
        body = F.struct(*values)
        aggs.append((~F.min(body).eqNullSafe(F.max(body))).alias("__mixed"))
        extra = [F.col("__mixed")]
    if mode == "coalesce":
        for c in values:
            aggs += [
                F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias("__last_" + c),
                F.min(c).alias("__lo_" + c), F.max(c).alias("__hi_" + c),
                F.bool_or(F.col(c).isNull()).alias("__gap_" + c),
            ]
        extra = [F.col(p + c) for c in values for p in ("__lo_", "__hi_", "__gap_")]
    one = source.groupBy(*keys).agg(*aggs)
    picked = [
        (F.col("__last_" + c) if mode == "coalesce" and c in values else F.col("__row")[c]).alias(c) for c in cols
    ]
    return one.select(*keys, *picked, *extra)


def upsert(
    target: DataFrame, source: DataFrame, keys: list[str], *, mode: str = "replace",
    update_cols: list[str] | None = None, insert_defaults: dict[str, object] | None = None,
    stamp_col: str | None = "dw_updatedat", order_col: str | None = None, raw_compare: bool = False,
) -> DataFrame:
    """Insert new keys, update known ones; result has the columns of `target`.

    mode      replace: source values win, stamp included. changed: as replace, but the stamp only moves
              if a column differs. coalesce: a NULL in the source keeps the old value, the stamp moves if
              a known value differs (raw_compare=True: also if the source has NULL for a known value).
    update_cols      columns to overwrite on known keys (default: all the source has); others keep their value.
    insert_defaults  values for new keys where the source has no such column.
    order_col        position in the batch; of equal keys the last wins. Not written to the target.
    """
    if mode not in MODES:
        raise ValueError(f"unknown merge mode {mode!r}, expected one of {MODES}")
    given = [c for c in source.columns if c not in keys and c != order_col]
    known = target.columns
    unknown = [c for c in given if c not in known]
    if unknown:
        raise ValueError(f"source columns not in target: {unknown}")
    updated = set(given if update_cols is None else update_cols)
    stamp = stamp_col if stamp_col in given else None
    compared = [c for c in given if c != stamp and c in updated]

    one = last_per_key(source, keys, order_col, mode, stamp)
    s = one.select(*[F.col(c).alias(c if c in keys else SRC + c) for c in one.columns], F.lit(True).alias("__new"))
    t = target.select(*[F.col(c).alias(c if c in keys else TGT + c) for c in target.columns], F.lit(True).alias("__old"))
    both = t.join(s, keys, "full_outer")

    is_new, is_old = F.col("__new").isNotNull(), F.col("__old").isNotNull()
    moved = F.lit(True)
    if mode == "changed":
        moved = differs([F.col(TGT + c) for c in compared], [F.col(SRC + c) for c in compared])
        if compared:
            moved = F.col(f"{SRC}__mixed") | moved
    elif mode == "coalesce":
        moved = reduce(or_, [_known_differs(c, raw_compare) for c in compared], F.lit(False))

    out = []
    for field in target.schema.fields:
        name = field.name
        if name in keys:
            out.append(F.col(name).cast(field.dataType).alias(name))
            continue
        old = F.col(TGT + name)
        if name not in given:
            fresh = F.lit((insert_defaults or {}).get(name))
            value = F.when(is_old, old).otherwise(fresh)
        else:
            new = F.col(SRC + name)
            if name == stamp:
                kept = F.when(moved, new).otherwise(old)
            elif name not in updated:
                kept = old
            elif mode == "coalesce":
                kept = F.coalesce(new, old)
            else:
                kept = new
            if name in (insert_defaults or {}):
                new = F.coalesce(new, F.lit(insert_defaults[name]))
            value = F.when(is_new & is_old, kept).when(is_new, new).otherwise(old)
        out.append(value.cast(field.dataType).alias(name))
    return both.select(*out)


def _known_differs(col: str, raw: bool) -> Column:
    """Whether any row of the batch changes the stored value of a column."""
    old, low, high = F.col(TGT + col), F.col(f"{SRC}__lo_{col}"), F.col(f"{SRC}__hi_{col}")
    known = low.isNotNull() & (old.isNull() | (low != old) | (high != old))
    known = F.coalesce(known, F.lit(False))
    return known | (F.col(f"{SRC}__gap_{col}") & old.isNotNull()) if raw else known


def insert_ignore(target: DataFrame, source: DataFrame, keys: list[str], order_col: str | None = None) -> DataFrame:
    """Append keys the target does not hold; known keys stay as they are, columns not given are NULL.

    Of equal keys in the source the first in order_col is taken, without an order the smallest row.
    """
    cols = [c for c in source.columns if c not in keys and c != order_col]
    row = F.struct(*cols) if cols else F.struct(F.lit(True).alias("__none"))
    first = F.min_by(row, order_col) if order_col else F.min(row)
    one = source.dropna(subset=keys).groupBy(*keys).agg(first.alias("__row")).select(*keys, *[F.col("__row")[c].alias(c) for c in cols])
    fresh = delete_keys(one, target, keys)
    return target.unionByName(fresh, allowMissingColumns=True).select(*target.columns)


def fold_feeds(feeds: list[tuple[DataFrame, list[str]]], keys: list[str]) -> DataFrame:
    """Several feeds as one row per key: for every set of columns written by the same feeds one struct, holding
    the values of the last of these feeds, or NULL where none of them knows the key.

    Each feed is (rows, order columns): of equal keys inside a feed the last in its order (text or time) wins.
    A feed writes the columns it has besides keys and those that start with two underscores.
    """
    parts, writers = [], {}
    for i, (rows, order) in enumerate(feeds):
        cols = [c for c in rows.columns if c not in keys and not c.startswith("__")]
        for c in cols:
            writers.setdefault(c, []).append(i)
        place = F.concat_ws("\x01", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order])
        parts.append(rows.dropna(subset=keys).select(*keys, *cols, F.lit(i).alias("__feed"), place.alias("__order")))
    batch = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    groups: dict[tuple[int, ...], list[str]] = {}
    for c, by in writers.items():
        groups.setdefault(tuple(by), []).append(c)
    rank = F.struct("__feed", "__order")
    structs = [
        F.max_by(F.struct(*cols), F.when(F.col("__feed").isin(list(by)), rank)).alias(f"__g{n}")
        for n, (by, cols) in enumerate(groups.items())
    ]
    return batch.groupBy(*keys).agg(*structs) if structs else batch.select(*keys).distinct()


def apply_feeds(target: DataFrame, folded: DataFrame, keys: list[str],
                insert_defaults: dict[str, object] | None = None, first: bool = False) -> DataFrame:
    """Merge folded feeds into a table; columns no feed knows keep their value, or take the default on new keys.

    first: the table has no rows yet. There is nothing to join then, and the rows stay where their keys lie.
    """
    source_of = {c: g.name for g in folded.schema.fields if g.name not in keys for c in g.dataType.names}
    t = target.select(*[F.col(c).alias(c if c in keys else TGT + c) for c in target.columns], F.lit(True).alias("__old"))
    both = folded if first else t.join(folded, keys, "full_outer")
    is_old = F.col("__old").isNotNull()
    out = []
    for field in target.schema.fields:
        name = field.name
        if name in keys:
            out.append(F.col(name).cast(field.dataType).alias(name))
            continue
        value = F.lit((insert_defaults or {}).get(name))
        if not first:
            value = F.when(is_old, F.col(TGT + name)).otherwise(value)
        if name in source_of:
            group = F.col(source_of[name])
            value = F.when(group.isNotNull(), group[name]).otherwise(value)
        out.append(value.cast(field.dataType).alias(name))
    return both.select(*out)


def upsert_feeds(target: DataFrame, feeds: list[tuple[DataFrame, list[str]]], keys: list[str], *,
                 insert_defaults: dict[str, object] | None = None, first: bool = False) -> DataFrame:
    """Several feeds into one table with one shuffle each side; per column the last feed that writes it wins.

    Equal to one upsert of a column subset after the other.
    """
    return apply_feeds(target, fold_feeds(feeds, keys), keys, insert_defaults, first)
