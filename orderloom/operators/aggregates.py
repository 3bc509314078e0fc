"""Grouped totals, ordered text and allocation shares (A, W1)."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.scalar import safe_ratio
from orderloom.operators.relational import join_back

GROUP = "__g_"
CHUNK_ROWS = 10_000


def totals(
    df: DataFrame, keys, sums: dict[str, Column] | None = None, mins: dict[str, Column] | None = None,
    maxs: dict[str, Column] | None = None, counts: dict[str, Column] | None = None,
) -> DataFrame:
    """Grouped sums, extremes and non-null counts, each given as output name -> expression."""
    aggs = [f(c).alias(n) for f, d in ((F.sum, sums), (F.min, mins), (F.max, maxs), (F.count, counts))
            for n, c in (d or {}).items()]
    return df.groupBy(*([keys] if isinstance(keys, str) else keys)).agg(*aggs)


def signed_totals(value: Column, prefix: str) -> list[Column]:
    """Sum of the values from 0 up and of those below 0; NULL where a part has none."""
    return [
        F.sum(F.when(value >= 0, value)).alias("positive_" + prefix),
        F.sum(F.when(value < 0, value)).alias("negative_" + prefix),
    ]


def ordered_text(df: DataFrame, keys: list[str], cols: dict[str, Column], order_by: list[Column], *, sep: str = ",", chunk: int = CHUNK_ROWS) -> DataFrame:
    """One ordered, delimited text per key and column; NULLs are skipped, none at all gives NULL. Ties are ordered by the text itself.

    Keys of up to `chunk` rows are sorted whole. Larger ones, which the counts of all keys name, are sorted over range partitions, cut into
    chunks there, and strung together up a tree of chunks, partitions and key: no task sorts or holds more rows than a partition has, and
    only the one cell of the result grows with its key.
    """
    at, size, key, of = (GROUP + n for n in ("at", "size", "key", "of"))
    # The key as one value, NULL in it equals NULL: counts, the join with them and the texts all find the rows in one place.
    rows = df.select(F.struct(*keys).alias(key), F.struct(*order_by).alias(at), *[c.cast("string").alias(n) for n, c in cols.items()])
    large = rows.groupBy(F.col(key).alias(of)).agg(F.count(F.lit(1)).alias(size)).filter(F.col(size) > chunk).drop(size)
    same = F.col(key) == F.col(of)

    def joined(pairs: Column, name: str) -> Column:
        return F.when(F.size(pairs) > 0, F.array_join(F.transform(F.array_sort(pairs), lambda x: x[name]), sep))

    pairs = {n: F.collect_list(F.when(F.col(n).isNotNull(), F.struct(at, n))) for n in cols}
    out = rows.join(large, same, "left_anti").groupBy(key).agg(*[joined(p, n).alias(n) for n, p in pairs.items()]).select(f"{key}.*", *cols)

    place, text, part, piece = (GROUP + n for n in ("place", "text", "part", "piece"))
    cells = rows.join(large, same, "left_semi").select(f"{key}.*", at, F.posexplode(F.array(*cols)).alias(place, text)).filter(F.col(text).isNotNull())
    # rows that are equal in all of these may be parted by the draw
    ranged = cells.withColumn(GROUP + "draw", F.rand(7)).repartitionByRange(*keys, place, at, text, GROUP + "draw").withColumn(part, F.spark_partition_id())
    rank = F.row_number().over(Window.partitionBy(*keys, place, part).orderBy(at, text))
    pieces = ranged.withColumn(piece, F.floor((rank - 1) / chunk)).groupBy(*keys, place, part, piece).agg(
        joined(F.collect_list(F.struct(at, text)), text).alias(text))
    for by, nth in (([*keys, place, part], piece), ([*keys, place], part)):
        pieces = pieces.groupBy(*by).agg(joined(F.collect_list(F.struct(nth, text)), text).alias(text))
    wide = pieces.groupBy(*[F.col(k).alias(GROUP + "of_" + k) for k in keys]).agg(*[F.max(F.when(F.col(place) == i, F.col(text))).alias(n) for i, n in enumerate(cols)])
    named = reduce(and_, [F.col(f"{of}.{k}").eqNullSafe(F.col(GROUP + "of_" + k)) for k in keys])
    return out.unionByName(large.join(wide, named, "left").select(f"{of}.*", *cols))


def collapse(df: DataFrame, keys: list[str], sums: list[str], count_as: str) -> DataFrame:
    """Equal lines become one with a count and summed amounts; lines with a missing key part vanish."""
    return (
        df.dropna(subset=keys).groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(count_as), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums])
    )


def average_price(df: DataFrame, key: str, price: Column, discount: Column | None = None,
                  qty: Column | None = None, out: str = "retailprice") -> DataFrame:
    """Rounded mean unit price per key; a division by a zero quantity counts as unknown."""
    unit = price if discount is None else price - F.try_divide(discount, qty)
    return df.groupBy(key).agg(F.round(F.avg(unit)).alias(out))


def with_totals(df: DataFrame, keys: list[str], totals_by: dict[str, Column]) -> DataFrame:
    """Every row with sums over its key group.

    Same result as a whole-partition window, but sums are pre-aggregated before the shuffle and
    joined back, so that a hot key is split by the adaptive join where a window would put it in one task.
    """
    return join_back(df, totals(df, keys, sums=totals_by), keys)


def over_group(df: DataFrame, keys: list[str], totals_by: dict[str, Column]) -> DataFrame:
    """As with_totals, by a window: rows that lie by the key already are neither shuffled nor computed again.

    For keys of few rows: one task sums a group, and spills it to disk if it is large.
    """
    of = Window.partitionBy(*keys)
    return df.withColumns({n: F.sum(c).over(of) for n, c in totals_by.items()})


def allocate(amount: Column, weight: Column, whole: Column) -> Column:
    """Share of an order amount for a line; 0 where the weights add up to 0."""
    return amount * safe_ratio(weight, whole)
