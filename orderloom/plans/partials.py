"""Monthly partial sums of the star, from which reports are added up.

A row per month, channel, outcome, parent product and courier holds sums, counts and a sketch of its parcels. All of these can be added up, so a
report of a year or of all time reads short rows, and after a run only the months that the run wrote are counted anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators.relational import lookup
from orderloom.sources.store import PART, TableStore

BY = ["month", "platform", "finalstatus", "parentproductid", "courier", "courieraccount"]
MEASURES = {
    "n_lines": "count(*)", "pieces": "sum(quantity)", "pieces_back": "sum(return_quantity)", "order_value": "sum(quantity * originalprice)",
    "shippingfee": "sum(shippingfee)", "cod": "sum(cod_collected_allquantity)", "parcels": "hll_sketch_agg(deliveryid)",
}
SCHEMA = ("month STRING, platform STRING, finalstatus STRING, parentproductid STRING, courier STRING, courieraccount STRING, n_lines BIGINT, pieces BIGINT, "
          "pieces_back BIGINT, order_value BIGINT, shippingfee DECIMAL(38,10), cod DECIMAL(38,10), parcels BINARY")
ADDED = {**{m: f"sum({m})" for m in MEASURES if m != "parcels"}, "n_parcels": "hll_sketch_estimate(hll_union_agg(parcels))"}


def partials(fact: DataFrame, dim_order: DataFrame, dim_delivery: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The partial sums of some fact rows; by: columns of the fact to keep them apart by as well. A month without a date is NULL."""
    rows = lookup(fact, dim_order, "orderid", ["createdat", "platform"], aligned=True)  # a built fact lies by order
    rows = lookup(rows, dim_delivery, {"deliveryid": "trackingnumber"}, ["courier", "courieraccount"])
    rows = rows.withColumn("month", F.date_format("createdat", "yyyy-MM"))
    return rows.groupBy(*(by or []), *BY).agg(*[F.expr(e).alias(m) for m, e in MEASURES.items()])


def refresh(store: TableStore, parts: list[str] | None = None) -> list[str]:
    """Count some partitions of the fact anew, all without a list; gives those that were written. Reads only these, and orders and parcels they name."""
    path, schema = store.path("report_partials"), f"{SCHEMA}, {PART} STRING"
    fact = store.read("fact_orderdetails", parts, with_part=True)
    found = partials(fact, store.reach("dim_order", fact, {"orderid": "orderid"}), store.reach("dim_delivery", fact, {"trackingnumber": "deliveryid"}), [PART])
    rows = found.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in schema.split(", ")])
    return store.overwrite_parts("report_partials", path, rows, None if parts is None else set(parts))


def read(store: TableStore) -> DataFrame:
    return store.spark.read.schema(f"{SCHEMA}, {PART} STRING").parquet(store.path("report_partials")).drop(PART)


def added(partial: DataFrame, by: list[str]) -> DataFrame:
    """The sums of partial rows by some of their columns, with the (estimated) number of parcels."""
    return partial.groupBy(*by).agg(*[F.expr(e).alias(m) for m, e in ADDED.items()])


def totals(partial: DataFrame, sets: list[list[str]]) -> DataFrame:
    """The sums by each of several sets of columns in one pass, with `level`: which set a row belongs to. Columns of other sets are NULL."""
    named = list(dict.fromkeys(c for s in sets for c in s))
    texts = ", ".join(f"({', '.join(s)})" for s in sets)
    partial.createOrReplaceTempView("orderloom_partials")
    sums = ", ".join(f"{e} AS {m}" for m, e in ADDED.items())
    level = " + ".join(["0", *(f"(1 - grouping({c}))" for c in named)])
    return partial.sparkSession.sql(f"SELECT {level} AS level, {', '.join(named)}, {sums} FROM orderloom_partials GROUP BY GROUPING SETS ({texts})")
