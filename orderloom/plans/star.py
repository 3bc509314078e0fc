"""Staging tables to star (B22-B37): every dimension and the fact as one merge each."""

from __future__ import annotations

from collections.abc import Callable, Collection
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.rules import not_in
from orderloom.functions.scalar import sku_prefix, surrogate
from orderloom.operators import outcome as o
from orderloom.operators.aggregates import average_price, ordered_text, signed_totals
from orderloom.operators.merge import insert_ignore, upsert_feeds
from orderloom.operators.relational import delete_keys, keep_keys, lookup, null_unmatched, under_owners, union_all, update_from
from orderloom.operators.settlement import settle
from orderloom.operators.tracking import changed_groups, since
from orderloom.schemas import BASE_MEASURES, STAR_KEYS, conform

UNCONFIRMED = ("don moi", "cho khach xac nhan")
DEFAULTS = {"fact_orderdetails": dict.fromkeys(
    [*BASE_MEASURES, "extradiscountamount_allquantity", "return_quantity"], 0)}

Tables = dict[str, DataFrame]
Marks = dict[str, datetime]
Feeds = list[tuple[DataFrame, list[str]]]
Stage = Callable[[DataFrame], DataFrame]
Merge = Callable[[str, Feeds], DataFrame]
Reach = Callable[[str, DataFrame, dict[str, str]], DataFrame]


def whole_tables(*groups: Tables) -> Reach:
    """Rows by key out of frames that are not partitioned: all rows, as the joins pick theirs."""
    tables = {name: df for group in groups for name, df in group.items()}
    return lambda name, keys, on: tables[name]


def _as(df: DataFrame, **cols: str | Column) -> DataFrame:
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in cols.items()])


def new_headers(lake: Tables, marks: Marks) -> Tables:
    """Order headers per channel that changed since the last build."""
    pos = since(lake["nhanhvnorders"], marks["nhanhvnorders"])
    pos = pos.filter(not_in(F.col("orderstatus"), UNCONFIRMED))
    return {
        "shopee": since(lake["shopeeorders"], marks["shopeeorders"]),
        "tiktok": since(lake["tiktokorders"], marks["tiktokorders"]),
        "pos": pos,
    }


def order_feeds(new: Tables) -> Feeds:
    """Headers of three channels."""
    shop = {"created_byperson": "shopname", "cancel_reason": "cancel_reason", "lastupdateat": "dw_updatedat"}
    shopee = _as(new["shopee"], orderid="orderid", createdat="createdat", status="orderstatus",
                 platform=F.lit("Shopee shops"), return_reason="returned_orderids", **shop)
    tiktok = _as(new["tiktok"], orderid="orderid", createdat="create_time", status="status",
                 platform=F.lit("Tiktok shops"), return_reason="return_reason", **shop)
    pos = _as(new["pos"], orderid="orderid", createdat="created_at", status="orderstatus",
              parentsource="orderparentsource", source="ordersource", platform="platform",
              created_byperson="created_byperson", is_wrongproduct="is_wrongproduct", lastupdateat="dw_updatedat")
    return [(shopee, []), (tiktok, []), (pos, [])]


def delivery_feeds(lake: Tables, new: Tables, marks: Marks) -> Feeds:
    """Parcels from the two marketplaces, the courier files and the handling notes, in this order."""
    shopee = _as(new["shopee"], trackingnumber="delivery_orderid", courier="courier", delivery_status="orderstatus",
                 createdat="createdat", pickupat="pickupat", deliveryat="completedat", lastupdateat="dw_updatedat",
                 __by="orderid")
    tiktok = _as(new["tiktok"], trackingnumber="tracking_number", courier="shipping_provider",
                 delivery_status="status", createdat="create_time", pickupat="collection_time",
                 deliveryat=F.coalesce("cancel_time", "delivery_time"), lastupdateat="dw_updatedat", __by="orderid")
    parcels = _as(since(lake["deliveryorders"], marks["deliveryorders"]),
                  trackingnumber="delivery_orderid", courier="courier", courieraccount="courieraccount",
                  delivery_status="orderstatus", createdat="createdat", pickupat="pickupat",
                  deliveryat="completedat", lastupdateat="dw_updatedat")
    notes = _as(since(lake["handle_deliveryorders"], marks["handle_deliveryorders"]),
                trackingnumber="delivery_orderid", scan_deliveryorder_at="scan_deliveryorder_at",
                handleteam_note1="handleteam_note1", handleteam_note2="handleteam_note2",
                handleteam_note3="handleteam_note3", lastupdateat="dw_updatedat")
    return [(shopee, ["lastupdateat", "__by"]), (tiktok, ["lastupdateat", "__by"]), (parcels, []), (notes, [])]


def parcel_keys(dim: DataFrame, lake: Tables, new: Tables, marks: Marks) -> DataFrame:
    """Tracking numbers the delivery dimension will hold after this run, without building it."""
    key = "trackingnumber"
    return union_all(
        dim.select(key), _as(new["shopee"], **{key: "delivery_orderid"}), _as(new["tiktok"], **{key: "tracking_number"}),
        _as(since(lake["deliveryorders"], marks["deliveryorders"]), **{key: "delivery_orderid"}),
        _as(since(lake["handle_deliveryorders"], marks["handle_deliveryorders"]), **{key: "delivery_orderid"}))


def fix_tracking(pos: DataFrame, dim_delivery: DataFrame) -> DataFrame:
    """Self-delivered orders get their sheet number; numbers no parcel has become NULL."""
    own = (F.col("deliverybrand") == o.SELF_COURIER) & F.col("trackingnumber").isNull()
    pos = pos.withColumn(
        "trackingnumber",
        F.when(own, F.concat(F.lit("TVC_GGSHEET_"), F.col("orderid"))).otherwise(F.col("trackingnumber")))
    return null_unmatched(pos, "trackingnumber", dim_delivery, "trackingnumber")


def customer_feeds(new: Tables) -> Feeds:
    """Buyers under a key made of account or phone and city; the latest order describes them."""
    account = F.coalesce("buyer_accountname", F.lit(""))
    shopee = _as(new["shopee"], customer_surrogateid=account, ecommerce_name=account, __at="dw_updatedat",
                 __by="orderid")
    tiktok = _as(new["tiktok"], customer_surrogateid=surrogate(F.col("buyer_email"), F.col("buyeraddress_lv1")),
                 ecommerce_name="buyer_email", country="buyeraddress_lv0", city="buyeraddress_lv1",
                 district="buyeraddress_lv2", __at="dw_updatedat", __by="orderid")
    pos = _as(new["pos"],
              customer_surrogateid=surrogate(F.col("customerphonenumber"), F.col("customer_cityaddress")),
              phonenumber="customerphonenumber", name="customername", country=F.lit("Viet Nam"),
              city="customer_cityaddress", district="customer_districtaddress", __at="dw_updatedat", __by="orderid")
    order = ["__at", "__by"]
    return [(shopee, order), (tiktok, order), (pos, order)]


def product_feeds(dim: DataFrame, lake: Tables, lines: Tables, marks: Marks) -> Feeds:
    """Parent skus nobody has listed, at their mean selling price; the first channel to sell one names it."""
    parent = "parentproductid"

    def priced(seq: int, df: DataFrame, *price: Column) -> DataFrame:
        return average_price(df.filter(F.col(parent).isNotNull()), parent, *price).withColumn("__seq", F.lit(seq))

    pos = since(lake["nhanhvnorderdetails"], marks["nhanhvnorderdetails"])
    pos = pos.withColumn("price", F.when(F.col(parent).isNotNull(), F.col("price")))
    pos = pos.withColumn(parent, F.coalesce(parent, F.lit("")))
    found = union_all(
        priced(0, lines["shopee"], F.col("realprice")),
        priced(1, lines["tiktok"], F.col("displayprice"), F.col("shopdiscount_allquantities"), F.col("quantity")),
        priced(2, pos, F.col("price"), F.col("discount_allproduct"), F.col("quantity")),
        # Orders without lines refer to the blank product.
        lines["pos"].filter(F.col(parent) == "").select(
            parent, F.lit(None).cast("double").alias("retailprice"), F.lit(3).alias("__seq")),
    )
    fresh = delete_keys(found, dim, {parent: "productid"})
    fresh = fresh.groupBy(F.col(parent).alias("productid")).agg(
        F.min_by(F.struct("retailprice"), "__seq")["retailprice"].cast("bigint").alias("retailprice"))
    return [(fresh, [])]


def transactions(new: Tables) -> DataFrame:
    """Keys under which the orders of this run are settled."""
    return union_all(_as(new["shopee"], id="orderid"), _as(new["tiktok"], id="orderid"),
                     _as(new["pos"], id="trackingnumber").dropna())


def history(name: str, key: str, lake: Tables, marks: Marks, new: Tables, reach: Reach | None) -> DataFrame:
    """All rows of keys with news, and of the orders of this run, whose money may have come before them."""
    also = transactions(new).withColumnRenamed("id", key)
    if reach is None:
        return changed_groups(lake[name], [key], marks[name], also=also)
    touched = since(lake[name], marks[name]).select(key).union(also).distinct()
    return keep_keys(reach(name, touched, {key: key}), touched, key)


def courier_money(lake: Tables, marks: Marks, new: Tables, reach: Reach | None = None, stage: Stage = lambda df: df) -> DataFrame:
    """Courier settlements per parcel (A7-A9). The rows are read several times: stage writes them once."""
    rows = stage(history("delivery_reconciliation", "delivery_orderid", lake, marks, new, reach))
    sums = rows.groupBy("delivery_orderid").agg(
        F.max("reconciliation_at").alias("max_at"), F.min("reconciliation_at").alias("min_at"),
        *signed_totals(F.col("reconciliation_value"), "amount"), F.max("dw_updatedat").alias("max_dw_updatedat"))
    at = F.col("reconciliation_at")
    texts = ordered_text(
        rows, ["delivery_orderid"],
        {"all_at": F.date_format(at, "yyyy-MM-dd HH:mm:ss"), "all_content": F.col("reconciliation_content"),
         "all_sessionid": F.col("sessionid")},
        [at, F.col("sessionid")])
    return lookup(sums, texts, "delivery_orderid", ["all_at", "all_content", "all_sessionid"])


def tiktok_money(lake: Tables, marks: Marks, new: Tables, reach: Reach | None = None, stage: Stage = lambda df: df) -> DataFrame:
    """Marketplace settlements per order or statement."""
    key, at = "order_or_statement_id", F.col("transactiontime")
    rows = stage(history("tiktok_reconciliation", key, lake, marks, new, reach))
    sums = rows.groupBy(key).agg(
        F.max(at).alias("max_at"), F.min(at).alias("min_at"), F.sum("revenue").alias("positive_amount"),
        F.sum("totalfee").alias("negative_amount"), F.max("dw_updatedat").alias("max_dw_updatedat"))
    texts = ordered_text(rows, [key], {"all_at": at}, [at])
    return lookup(sums, texts, key, ["all_at"])


def reconciliation_feeds(lake: Tables, new: Tables, marks: Marks, couriers: DataFrame, tiktok: DataFrame) -> Feeds:
    """One row per key that may be settled, and what was settled so far."""
    key = "order_or_delivery_id"
    placeholders = union_all(
        _as(new["shopee"], **{key: "orderid"}), _as(new["tiktok"], **{key: "orderid"}),
        _as(since(lake["deliveryorders"], marks["deliveryorders"]), **{key: "delivery_orderid"}),
        _as(new["pos"], **{key: "trackingnumber"}),
    )
    paid = _as(couriers, **{key: "delivery_orderid"}, max_transactiontime="max_at", min_transactiontime="min_at",
               all_sessionid="all_sessionid", all_transactiontime="all_at", allcontent="all_content")
    market = _as(tiktok, **{key: "order_or_statement_id"},
                 max_transactiontime=F.col("max_at").cast("timestamp_ntz"),
                 min_transactiontime=F.col("min_at").cast("timestamp_ntz"), all_transactiontime="all_at")
    return [(placeholders, []), (paid, []), (market, [])]


def new_lines(lake: Tables, new: Tables, reach: Reach | None = None) -> Tables:
    """Changed headers with their lines; marketplace headers without lines have no product and are left out."""
    reach = reach or whole_tables(lake)
    of = {name: reach(name, new[channel].select("orderid"), {"orderid": "orderid"}) for channel, name in (
        ("shopee", "shopeeorderdetails"), ("tiktok", "tiktokorderdetails"), ("pos", "nhanhvnorderdetails"))}
    shopee = lookup(new["shopee"], of["shopeeorderdetails"], "orderid", [
        "product_skuid", "orderproduct_id", "quantity", "displayprice", "realprice", "shopdiscount_allquantities"], aligned=True)
    tiktok = lookup(new["tiktok"], of["tiktokorderdetails"], "orderid", [
        "product_skuid", "quantity", "displayprice", "shopdiscount_allquantities"], aligned=True)
    pos = lookup(new["pos"], of["nhanhvnorderdetails"], "orderid", [
        "productid", "parentproductid", "price", "quantity", "discount_allproduct"], aligned=True)
    with_parent = {"parentproductid": sku_prefix(F.col("product_skuid"))}
    blank = {c: F.coalesce(c, F.lit("")) for c in ("productid", "parentproductid")}
    return {
        "shopee": shopee.dropna(subset=["product_skuid"]).withColumns(with_parent),
        "tiktok": tiktok.dropna(subset=["product_skuid"]).withColumns(with_parent),
        "pos": pos.withColumns(blank),
    }


def fact_feeds(lines: Tables) -> Feeds:
    """Order lines of the three channels, with the measures each of them knows."""
    pos = _as(
        lines["pos"], orderid="orderid", productid="productid", parentproductid="parentproductid",
        deliveryid="trackingnumber",
        customer_surrogateid=surrogate(F.col("customerphonenumber"), F.col("customer_cityaddress")),
        transaction_orderid="trackingnumber",
        baseorder_codprepaid_allquantity=F.coalesce("cod_prepaid", F.lit(0)).cast("double"),
        quantity=F.coalesce("quantity", F.lit(0)), originalprice=F.coalesce("price", F.lit(0)),
        discountamount_allquantity=F.coalesce("discount_allproduct", F.lit(0)).cast("double"),
        lastupdateat="dw_updatedat")
    # A value of its own: as a second name of the order it would make the rows lie by either, and the union by none.
    same = F.concat("orderid", F.lit(""))
    qty, shown, off = F.col("quantity"), F.col("displayprice"), F.col("shopdiscount_allquantities")
    shopee = _as(
        lines["shopee"], orderid="orderid", productid=F.concat_ws("_", "product_skuid", "orderproduct_id"),
        parentproductid="parentproductid", deliveryid="delivery_orderid",
        customer_surrogateid=F.coalesce("buyer_accountname", F.lit("")), transaction_orderid=same,
        baseorder_cod_collected_allquantity=F.col("realprice") * qty - off, quantity=qty, originalprice=shown,
        discountamount_allquantity=shown - F.col("realprice"),
        extradiscountamount_allquantity=off.cast("decimal(25,10)"), lastupdateat="dw_updatedat")
    tiktok = _as(
        lines["tiktok"], orderid="orderid", productid="product_skuid", parentproductid="parentproductid",
        deliveryid="tracking_number",
        customer_surrogateid=surrogate(F.col("buyer_email"), F.col("buyeraddress_lv1")),
        transaction_orderid=same, baseorder_cod_collected_allquantity=(shown * qty - off).cast("double"),
        quantity=qty, originalprice=shown, discountamount_allquantity=off.cast("double"),
        lastupdateat="dw_updatedat")
    return [(pos, []), (shopee, []), (tiktok, [])]


def merged(name: str, table: DataFrame, feeds: Feeds, first: bool = False) -> DataFrame:
    """A star table after its feeds; first: it has no rows yet."""
    return upsert_feeds(table, feeds, STAR_KEYS[name], insert_defaults=DEFAULTS.get(name), first=first)


def references(fact: DataFrame, new: Tables) -> DataFrame:
    """Parcel and transaction of every order: those of its lines so far and those of its new header. All lines have one of these."""
    return union_all(
        fact.select("orderid", "deliveryid", "transaction_orderid"),
        _as(new["shopee"], orderid="orderid", deliveryid="delivery_orderid", transaction_orderid="orderid"),
        _as(new["tiktok"], orderid="orderid", deliveryid="tracking_number", transaction_orderid="orderid"),
        _as(new["pos"], orderid="orderid", deliveryid="trackingnumber", transaction_orderid="trackingnumber"))


def _update(fact: DataFrame, source: DataFrame, on: dict[str, str], rules: dict, refs: DataFrame | None) -> DataFrame:
    """update_from by the first column of `on`, which with refs is looked up per order: the fact then stays with its orders."""
    if refs is None:
        return update_from(fact, source, on, rules)
    col, key = next(iter(on.items()))
    return update_from(fact, under_owners(source, key, refs, col, "orderid"), {"orderid": "orderid", **on}, rules, aligned=True)


def _newer(stamp: str):
    return lambda old, right: F.greatest(old, right(stamp))


def _keep_null(name: str):
    return lambda old, right: F.coalesce(right(name).cast("double"), old)


def apply_parcels(fact: DataFrame, parcels: DataFrame, refs: DataFrame | None = None) -> DataFrame:
    """Shipping cost and collected money by parcel state."""
    def cost(old, right):
        status, value = right("orderstatus"), right("shippingcost").cast("double")
        return F.when(value.isNull(), old).when(status.isin(*o.FREE_STATUSES), F.lit(0.0)).otherwise(value)

    def cod(old, right):
        status, value = right("orderstatus"), right("cod_collected").cast("double")
        return F.when(value.isNull(), old).when(not_in(status, o.COD_KEPT_STATUSES), F.lit(0.0)).otherwise(value)

    source = parcels.select("delivery_orderid", "orderstatus", "shippingcost", "cod_collected", "dw_updatedat")
    return _update(fact, source, {"deliveryid": "delivery_orderid"}, {
        "baseorder_shippingfee": cost, "baseorder_cod_collected_allquantity": cod,
        "lastupdateat": _newer("dw_updatedat")}, refs)


def apply_bank(fact: DataFrame, banks: DataFrame) -> DataFrame:
    """Transfers per order."""
    source = banks.groupBy("orderid").agg(F.sum(F.col("bankvalue").cast("decimal(18,6)")).alias("value"), F.max("dw_updatedat").alias("at"))
    return update_from(fact, source, "orderid", {
        "baseorder_codbank_collected_allquantity": _keep_null("value"), "lastupdateat": _newer("at")}, aligned=True)


def apply_money(fact: DataFrame, couriers: DataFrame, tiktok: DataFrame, refs: DataFrame | None = None) -> DataFrame:
    """Settlements per transaction (B31). A key in both sources takes the marketplace amount where there is one."""
    amounts = ("positive_amount", "negative_amount")

    def part(df: DataFrame, key: str, seq: int) -> DataFrame:
        return _as(df, id=key, **{c: c for c in amounts}, at="max_dw_updatedat", seq=F.lit(seq))

    both = union_all(part(couriers, "delivery_orderid", 0), part(tiktok, "order_or_statement_id", 1))
    source = both.groupBy("id").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq"))).alias(c) for c in amounts], F.max("at").alias("at"))
    return _update(fact, source, {"transaction_orderid": "id"}, {
        "baseorder_positive_reconciliation_allquantity": _keep_null("positive_amount"),
        "baseorder_negative_reconciliation_allquantity": _keep_null("negative_amount"),
        "lastupdateat": _newer("at")}, refs)


def apply_returns(fact: DataFrame, scans: DataFrame, refs: DataFrame | None = None) -> DataFrame:
    """Scanned pieces per parcel and sku."""
    source = scans.filter(F.col("delivery_orderid").isNotNull() & F.col("productid").isNotNull())
    if refs is not None:  # counted where the join with the references wants them
        source = source.select("delivery_orderid", "productid", "dw_updatedat").repartition("delivery_orderid")
    source = source.groupBy("delivery_orderid", "productid").agg(
        F.count("productid").alias("n"), F.max("dw_updatedat").alias("at"))
    keyed = fact.withColumn("__sku", sku_prefix(F.col("productid"), "_"))
    out = _update(keyed, source, {"deliveryid": "delivery_orderid", "__sku": "productid"}, {
        "return_quantity": lambda old, right: F.coalesce(right("n"), old), "lastupdateat": _newer("at")}, refs)
    return out.drop("__sku")


def touched_orders(fact: DataFrame, lake: Tables, new: Tables, marks: Marks, couriers: DataFrame,
                   tiktok: DataFrame) -> DataFrame:
    """Orders whose fact rows can change in this run: new headers, and orders of changed parcels, transfers,
    settlements and returns."""
    changed = union_all(
        _as(since(lake["deliveryorders"], marks["deliveryorders"]), id="delivery_orderid"),
        _as(since(lake["returnedorders_scan"], marks["returnedorders_scan"]), id="delivery_orderid"))
    settled = union_all(_as(couriers, id="delivery_orderid"), _as(tiktok, id="order_or_statement_id"))
    slim = fact.select("orderid", "deliveryid", "transaction_orderid")
    return union_all(
        *[new[channel].select("orderid") for channel in ("shopee", "tiktok", "pos")],
        _as(since(lake["customerbanks"], marks["customerbanks"]), orderid="orderid"),
        keep_keys(slim, changed, {"deliveryid": "id"}).select("orderid"),
        keep_keys(slim, settled, {"transaction_orderid": "id"}).select("orderid"),
    ).distinct()


def build_star(lake: Tables, star: Tables, marks: Marks, *, by_order: bool = False, only_touched: bool = False,
               stage: Stage | None = None, merge: Merge | None = None, reach: Reach | None = None,
               first: Collection[str] = ()) -> Tables:
    """The star after one run over the staging tables.

    by_order      recompute all lines of an order with a newer line (equals a full recompute); otherwise only
                  the newer lines themselves
    only_touched  the fact in the result holds just the orders that can change, to be merged by key
    stage         called for results that several steps read; give it back from storage to cut the plan there
    merge         called with (dimension, feeds) to bring a dimension up to date; by default a lazy merge
    reach         called with (table, keys, {column: column of keys}) for rows of a stored table by key, so that only the partitions
                  that hold some are read; by default the whole tables are joined
    first         star tables that have no rows yet
    """
    stored = reach is not None
    stage = stage or (lambda df: df)
    merge = merge or (lambda name, feeds: conform(merged(name, star[name], feeds, name in first), name))
    new = new_headers(lake, marks)
    if stored:  # looked up in many tables
        new = {channel: stage(df) for channel, df in new.items()}
    known = parcel_keys(star["dim_delivery"], lake, new, marks)
    new["pos"] = stage(fix_tracking(new["pos"], known))
    lines = new_lines(lake, new, reach)
    couriers, tiktok = stage(courier_money(lake, marks, new, reach, stage)), stage(tiktok_money(lake, marks, new, reach, stage))

    dims = {
        "dim_order": merge("dim_order", order_feeds(new)),
        "dim_delivery": merge("dim_delivery", delivery_feeds(lake, new, marks)),
        "dim_customer": merge("dim_customer", customer_feeds(new)),
        "dim_product": merge("dim_product", product_feeds(star["dim_product"], lake, lines, marks)),
        "dim_reconciliation": merge(
            "dim_reconciliation", reconciliation_feeds(lake, new, marks, couriers, tiktok)),
    }
    old = star["fact_orderdetails"]
    if only_touched:
        touched = stage(touched_orders(old, lake, new, marks, couriers, tiktok))
        old = reach("fact_orderdetails", touched, {"orderid": "orderid"}) if stored else keep_keys(old, touched, "orderid")
    # Lines are shuffled once, by order. What is known by parcel or transaction is brought to the orders first.
    refs = references(old, new)
    fact = merged("fact_orderdetails", old, fact_feeds(lines), "fact_orderdetails" in first)
    reach = reach or whole_tables(lake, dims)
    if stored:  # its keys say which partitions of the other tables are read
        fact = stage(fact)
    fact = apply_parcels(fact, reach("deliveryorders", fact, {"delivery_orderid": "deliveryid"}), refs)
    fact = apply_returns(fact, reach("returnedorders_scan", fact, {"delivery_orderid": "deliveryid"}), refs)
    fact = apply_money(fact, couriers, tiktok, refs)
    fact = apply_bank(fact, reach("customerbanks", fact, {"orderid": "orderid"}))
    if stored:
        fact = stage(fact)
    fact = settle(fact, reach("dim_order", fact, {"orderid": "orderid"}), reach("dim_delivery", fact, {"trackingnumber": "deliveryid"}),
                  marks["fact and dim tables"], by_order, refs)
    return {**dims, "fact_orderdetails": conform(fact, "fact_orderdetails")}


def advance_log(log: DataFrame, marks: dict[str, datetime]) -> DataFrame:
    """The log with the highest stamp of all staging tables and of the fact, as the writes of these tables saw them."""
    rows = [(name, at) for name, at in marks.items() if at is not None]
    return insert_ignore(log, log.sparkSession.createDataFrame(rows, log.schema), ["dwtable_name", "updatetime"])
