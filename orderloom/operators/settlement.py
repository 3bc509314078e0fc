"""Outcome and money per order line from one set of fact rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators import outcome as o
from orderloom.operators.aggregates import allocate, over_group
from orderloom.operators.relational import lookup, under_owners

MARKETPLACES = ("Shopee shops", "Tiktok shops")
# Kept values may be fractions of a dong. They are summed as decimals, exactly, so that a total does not
# depend on the order tasks finish in. All other amounts are whole.
EXACT = "decimal(28,10)"


def classify(fact: DataFrame, dim_order: DataFrame, dim_delivery: DataFrame, mark: datetime | None = None,
             by_order: bool = False, refs: DataFrame | None = None) -> DataFrame:
    """Fact rows with finalstatus, plus helper columns: order sums, line value, platform, gate.

    mark       relabel only rows stamped after it, others keep what they hold.
    by_order   widen that gate to all lines of an order with a newer line. This equals a full
               recompute; gating by line leaves a sibling line as it was.

    refs       orders with all parcels their lines may refer to, if they are known from elsewhere: parcels are
               then looked up for these short rows, and the lines stay where their order is.

    `fact` must hold whole orders. Sums by order are windowed: an order holds a product once, so that its lines
    are bounded by the catalogue. One shuffle by order serves the header and all sums.
    """
    value = F.col("quantity") * F.col("originalprice") - F.col("discountamount_allquantity") \
        - F.col("extradiscountamount_allquantity").cast("double")
    rows = fact.withColumn("__value", value)
    sums = {"__qty": F.col("quantity"), "__total": F.col("__value")}
    newer = F.coalesce(F.col("lastupdateat") > F.lit(mark).cast("timestamp_ntz"), F.lit(False))
    if mark is not None and by_order:
        sums["__new"] = newer.cast("int")
    rows = lookup(over_group(rows, ["orderid"], sums), dim_order, "orderid", {
        "parentsource": "__parent", "status": "__status", "return_reason": "__reason", "platform": "__platform"}, aligned=True)
    if mark is None:
        gate = F.lit(True)
    else:
        gate = F.col("__new") > 0 if by_order else newer
    on = {"deliveryid": "trackingnumber"}
    if refs is not None:
        dim_delivery = under_owners(dim_delivery.select("trackingnumber", "courier", "delivery_status"), "trackingnumber", refs, "deliveryid", "orderid")
        on = {"orderid": "orderid", **on}
    rows = lookup(rows.withColumn("__gate", gate), dim_delivery, on, {
        "courier": "__courier", "delivery_status": "__delivery"}, aligned=refs is not None)
    rows = rows.withColumn("__paid", o.paid(
        F.col("baseorder_cod_collected_allquantity"), F.col("baseorder_codbank_collected_allquantity"),
        F.col("baseorder_codprepaid_allquantity")))
    label = o.outcome(
        parentsource="__parent", order_status="__status", return_reason="__reason", courier="__courier",
        delivery_status="__delivery", paid="__paid", returned="return_quantity", total_quantity="__qty",
        total_amount="__total")
    label = F.when(F.col("__gate"), label).otherwise(F.col("finalstatus"))
    return rows.withColumn("finalstatus", label)


def settle(fact: DataFrame, dim_order: DataFrame, dim_delivery: DataFrame, mark: datetime | None = None,
           by_order: bool = False, refs: DataFrame | None = None) -> DataFrame:
    """Fact rows with finalstatus and all line-grain money filled in; see classify for the gate."""
    rows = classify(fact, dim_order, dim_delivery, mark, by_order, refs)
    success = o.success_value(
        F.col("finalstatus"), F.col("quantity"), F.col("originalprice"), F.col("discountamount_allquantity"),
        F.col("extradiscountamount_allquantity"), F.col("return_quantity"))
    rows = rows.withColumn("__success", success)
    rows = over_group(rows, ["orderid"], {"__kept": F.col("__success").cast(EXACT)})

    by_quantity = (F.col("quantity"), F.col("__qty"))
    by_success = (F.col("__success").cast(EXACT).cast("double"), F.col("__kept").cast("double"))
    positive = F.col("baseorder_positive_reconciliation_allquantity")
    new = {
        "shippingfee": allocate(F.col("baseorder_shippingfee"), *by_quantity),
        "negative_reconciliation_allquantity":
            allocate(F.col("baseorder_negative_reconciliation_allquantity"), *by_quantity),
        "cod_collected_allquantity":
            F.when(~F.col("__platform").isin(*MARKETPLACES),
                   allocate(F.col("baseorder_cod_collected_allquantity"), *by_success))
            .otherwise(F.col("__success")),
        "codbank_collected_allquantity":
            allocate(F.col("baseorder_codbank_collected_allquantity"), *by_success),
        "positive_reconciliation_allquantity":
            F.when(F.col("finalstatus").isin(o.CANCELLED, o.PENDING), allocate(positive, *by_quantity))
            .otherwise(allocate(positive, *by_success)),
        "codprepaid_allquantity":
            allocate(F.col("baseorder_codprepaid_allquantity"), F.col("__value"), F.col("__total")),
    }
    types = {f.name: f.dataType for f in fact.schema.fields}
    return rows.select(*[
        F.when(F.col("__gate"), new[n]).otherwise(F.col(n)).cast(types[n]).alias(n) if n in new else F.col(n)
        for n in fact.columns
    ])
