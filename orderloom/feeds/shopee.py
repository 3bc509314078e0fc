"""Shopee orders, lines and income -> shopeeorders, shopeeorderdetails, delivery_reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions import scalar as s
from orderloom.operators.quality import fail_rows
from orderloom.operators.relational import lookup, to_contract
from orderloom.sources.landed import explode_path, pick

ORDERS = """
order_sn STRING, package_list ARRAY<STRUCT<package_number: STRING, shipping_carrier: STRING>>, create_time BIGINT,
pickup_done_time BIGINT, update_time BIGINT, order_status STRING, cancel_reason STRING, buyer_username STRING,
item_list ARRAY<STRUCT<item_sku: STRING, model_sku: STRING, model_id: STRING, item_id: STRING, item_name: STRING,
  model_name: STRING, model_quantity_purchased: BIGINT, model_original_price: BIGINT, model_discounted_price: DOUBLE>>
"""
ESCROWS = """
order_sn STRING, return_order_sn_list ARRAY<STRING>, buyer_payment_info STRUCT<buyer_total_amount: BIGINT>,
order_income STRUCT<buyer_payment_method: STRING, escrow_amount: BIGINT, actual_shipping_fee: BIGINT,
  shopee_shipping_rebate: BIGINT, seller_shipping_discount: BIGINT, items: ARRAY<STRUCT<model_sku: STRING,
  model_id: STRING, item_id: STRING, quantity_purchased: BIGINT, seller_discount: BIGINT,
  discount_from_voucher_seller: BIGINT, discount_from_voucher_shopee: BIGINT>>>
"""
TRACKINGS = "package_number STRING, tracking_number STRING"
INCOMES = "order_sn STRING, released_amount BIGINT, actual_payout_time BIGINT"


def clean_shopee_orders(orders: DataFrame, escrows: DataFrame, trackings: DataFrame, shop: str) -> DataFrame:
    """Headers with the money of the escrow and the tracking number of the first parcel."""
    rows = pick(orders, {
        "orderid": "order_sn", "packageid": "package_list[0].package_number",
        "carrier": "package_list[0].shipping_carrier", "create_time": "create_time", "pickup": "pickup_done_time",
        "update_time": "update_time", "orderstatus": "order_status", "cancel_reason": "cancel_reason",
        "buyer_accountname": "buyer_username"})
    money = pick(escrows, {
        "id": "order_sn", "returns": "return_order_sn_list", "buyer_paymentmethod": "order_income.buyer_payment_method",
        "collectedvalue_theory": "order_income.escrow_amount", "buyerpaidvalue": "buyer_payment_info.buyer_total_amount",
        "shippingcost": "order_income.actual_shipping_fee",
        "shippingcostdiscounted_byplatform": "order_income.shopee_shipping_rebate",
        "shippingcostdiscounted_byseller": "order_income.seller_shipping_discount"})
    rows = lookup(rows, money, {"orderid": "id"}, [c for c in money.columns if c != "id"])
    rows = lookup(rows, trackings, {"packageid": "package_number"}, ["tracking_number"])
    done = F.when(F.col("orderstatus") == "COMPLETED", F.col("update_time"))
    same = ("orderstatus", "cancel_reason", "buyer_accountname")
    paid = ("buyer_paymentmethod", "collectedvalue_theory", "buyerpaidvalue", "shippingcost",
            "shippingcostdiscounted_byplatform", "shippingcostdiscounted_byseller")
    return to_contract(rows, {
        "orderid": "orderid", "packageid": "packageid", "courier": s.fold_diacritics(F.col("carrier")),
        "createdat": s.local_time(F.col("create_time")), "pickupat": s.local_time(s.null_if(F.col("pickup"), 0)),
        "completedat": s.local_time(done), **{c: c for c in same},
        "returned_orderids": s.list_text(F.col("returns")), **{c: c for c in paid},
        "delivery_orderid": s.null_if_blank(F.col("tracking_number"))}, {"shopname": shop})


def clean_shopee_lines(orders: DataFrame, escrows: DataFrame) -> DataFrame:
    """Lines with the discounts of their escrow line; a line without one must not be loaded."""
    def line_key(quantity: str):
        return F.concat_ws("_", *[F.coalesce(F.col(c).cast("string"), F.lit("None"))
                                  for c in ("item.model_id", "item.item_id", quantity)])

    items = explode_path(orders, "item_list", [F.col("order_sn").alias("orderid")])
    items = items.withColumns({"product_skuid": F.col("item.model_sku"),
                               "orderproduct_id": line_key("item.model_quantity_purchased")})
    off = explode_path(escrows, "order_income.items", [F.col("order_sn").alias("orderid")])
    off = off.select(
        "orderid", F.col("item.model_sku").alias("product_skuid"),
        line_key("item.quantity_purchased").alias("orderproduct_id"), F.col("item.seller_discount").alias("off"),
        F.col("item.discount_from_voucher_seller").alias("shopdiscount_allquantities"),
        F.col("item.discount_from_voucher_shopee").alias("shopeediscount_allquantities"))
    rows = lookup(items, off, ["orderid", "product_skuid", "orderproduct_id"],
                  ["off", "shopdiscount_allquantities", "shopeediscount_allquantities"])
    rows = fail_rows(rows, {"line without escrow line": F.col("off").isNull()})
    price, shown, qty = F.col("item.model_discounted_price"), F.col("item.model_original_price"), F.col(
        "item.model_quantity_purchased")
    real = F.when(price == 0, shown - F.try_divide(F.col("off"), qty)).otherwise(price)
    return to_contract(rows, {
        "orderid": "orderid", "product_skuid": "product_skuid", "orderproduct_id": "orderproduct_id",
        "productid": F.col("item.item_sku"), "productname": F.col("item.item_name"),
        "product_skuname": F.col("item.model_name"), "quantity": qty, "displayprice": shown, "realprice": real,
        "shopdiscount_allquantities": "shopdiscount_allquantities",
        "shopeediscount_allquantities": "shopeediscount_allquantities"})


def clean_shopee_income(incomes: DataFrame) -> DataFrame:
    """Payouts as settlements; the session id names order, amount and time."""
    session = F.concat(F.col("order_sn"), F.lit("_"), F.col("released_amount").cast("string"), F.lit("_"),
                       F.col("actual_payout_time").cast("string"))
    return to_contract(incomes, {
        "sessionid": session, "delivery_orderid": "order_sn", "reconciliation_value": "released_amount",
        "reconciliation_at": s.local_time(F.col("actual_payout_time"))},
        {"courier": "Orders from Shopee Shops", "reconciliation_content": F.lit(None).cast("string")})
