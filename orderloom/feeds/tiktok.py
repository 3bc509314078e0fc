"""TikTok orders, lines and settlements -> tiktokorders, tiktokorderdetails, tiktok_reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.feeds.couriers import col
from orderloom.functions import scalar as s
from orderloom.operators.aggregates import collapse
from orderloom.operators.quality import flag_files
from orderloom.operators.relational import lookup, to_contract
from orderloom.operators.windows import first_per_key, latest_per_key
from orderloom.sources.landed import explode_path, pick

ORDERS = """
id STRING, shipping_provider STRING, create_time BIGINT, collection_time BIGINT, delivery_time BIGINT,
cancel_time BIGINT, status STRING, cancel_reason STRING, buyer_email STRING, payment_method_name STRING,
tracking_number STRING, payment STRUCT<original_shipping_fee: STRING, shipping_fee: STRING,
  shipping_fee_platform_discount: STRING, shipping_fee_seller_discount: STRING>,
recipient_address STRUCT<district_info: ARRAY<STRUCT<address_name: STRING>>>,
line_items ARRAY<STRUCT<seller_sku: STRING, product_id: STRING, product_name: STRING, sku_name: STRING,
  original_price: STRING, seller_discount: STRING, platform_discount: STRING>>
"""
RETURNS = """
order_id STRING, create_time BIGINT, return_reason_text STRING, return_tracking_number STRING, return_status STRING,
shipping_fee_amount ARRAY<STRUCT<buyer_paid_return_shipping_fee: STRING, platform_paid_return_shipping_fee: STRING,
  seller_paid_return_shipping_fee: STRING>>
"""
# The columns of the settlement file and the staging columns they fill.
INCOME = {
    "order_or_statement_id": "ID đơn hàng/điều chỉnh", "transactiontime": "Thời gian quyết toán đơn hàng",
    "transactiontype": "Loại giao dịch", "settlement_amount": "Tổng số tiền quyết toán", "revenue": "Tổng doanh thu",
    "subtotal_after_discount": "Tổng phụ sau giảm giá của người bán",
    "subtotal_before_discount": "Tổng phụ trước giảm giá", "seller_discount": "Giảm giá của người bán",
    "refund_subtotal_after_discount": "Tổng phụ của khoản hoàn tiền sau giảm giá của người bán",
    "refund_subtotal_before_discount": "Tổng phụ hoàn tiền trước giảm giá của người bán",
    "refundforseller_amount": "Khoản hoàn tiền giảm giá của người bán", "totalfee": "Tổng phí",
}


def _number(column):
    """A text amount; blank is unknown, other text fails the query."""
    return s.null_if_blank(column).cast("double").cast("bigint")


def clean_tiktok_orders(orders: DataFrame, returns: DataFrame, shop: str) -> DataFrame:
    """Headers with the latest return of each order."""
    rows = pick(orders, {
        "orderid": "id", "shipping_provider": "shipping_provider", "create_time": "create_time",
        "collection_time": "collection_time", "delivery_time": "delivery_time", "cancel_time": "cancel_time",
        "status": "status", "cancel_reason": "cancel_reason", "buyer_email": "buyer_email",
        "payment_method_name": "payment_method_name", "original_shipping_fee": "payment.original_shipping_fee",
        "actual_shipping_fee": "payment.shipping_fee",
        "shipping_fee_platform_discount": "payment.shipping_fee_platform_discount",
        "shipping_fee_seller_discount": "payment.shipping_fee_seller_discount", "tracking_number": "tracking_number",
        **{f"buyeraddress_lv{i}": f"recipient_address.district_info[{i}].address_name" for i in range(3)}})
    fees = F.col("shipping_fee_amount")
    back = returns.select(
        "order_id", "create_time", F.col("return_reason_text").alias("return_reason"),
        s.truncate_to(F.col("return_tracking_number"), 50).alias("returned_trackingnumber"),
        F.col("return_status").alias("returnstatus"),
        *[s.sum_array(fees, f"{who}_paid_return_shipping_fee").alias(f"returnshippingfee_paidby{who}")
          for who in ("buyer", "platform", "seller")])
    back = latest_per_key(back, "order_id", [F.col("create_time"), F.col("returned_trackingnumber")])
    added = [c for c in back.columns if c not in ("order_id", "create_time")]
    rows = lookup(rows, back, {"orderid": "order_id"}, added)
    times = ("create_time", "collection_time", "delivery_time", "cancel_time")
    amounts = ("original_shipping_fee", "actual_shipping_fee", "shipping_fee_platform_discount",
               "shipping_fee_seller_discount")
    folded = ("cancel_reason", "shipping_provider", "buyeraddress_lv0", "buyeraddress_lv1", "buyeraddress_lv2")
    rows = rows.withColumns({
        **{c: s.local_time(F.col(c)) for c in times}, **{c: _number(F.col(c)) for c in amounts},
        **{c: s.fold_diacritics(F.col(c)) for c in folded}, "shopname": F.lit(shop)})
    return rows.select("orderid", *times, "status", "cancel_reason", "buyer_email", "payment_method_name", *amounts,
                       "tracking_number", "shipping_provider", *folded[2:], *added, "shopname")


LINE_KEYS = ["orderid", "product_skuid", "productid", "productname", "product_skuname", "displayprice"]


def clean_tiktok_lines(orders: DataFrame) -> DataFrame:
    """Equal items become one line with a quantity; of several lines of a sku the first is kept."""
    items = explode_path(orders, "line_items", [F.col("id").alias("orderid")])
    rows = items.select(
        "orderid", F.col("item.seller_sku").alias("product_skuid"), F.col("item.product_id").alias("productid"),
        F.col("item.product_name").alias("productname"), F.col("item.sku_name").alias("product_skuname"),
        _number(F.col("item.original_price")).alias("displayprice"),
        _number(F.col("item.seller_discount")).alias("shopdiscount_allquantities"),
        _number(F.col("item.platform_discount")).alias("tiktokdiscount_allquantities"))
    lines = collapse(rows, LINE_KEYS, ["shopdiscount_allquantities", "tiktokdiscount_allquantities"], "quantity")
    lines = first_per_key(lines, ["orderid", "product_skuid"], [F.col(c) for c in LINE_KEYS[2:]])
    return lines.select(*LINE_KEYS, "quantity", "shopdiscount_allquantities", "tiktokdiscount_allquantities")


def clean_tiktok_income(income: DataFrame) -> DataFrame:
    """Settlements; files with an amount that is not whole are left out."""
    amounts = [c for n, c in INCOME.items() if n not in ("order_or_statement_id", "transactiontime", "transactiontype")]
    unsound = F.lit(False)
    for name in amounts:
        unsound = unsound | ~s.matches(col(name).cast("string"), r"^-?\d+$")
    rows = income.join(flag_files(income, unsound), "source_file", "left_anti")
    return to_contract(rows, {
        **{n: col(c).cast("bigint") if c in amounts else c for n, c in INCOME.items()},
        "transactiontime": s.parse_time_strict(col(INCOME["transactiontime"]), "yyyy/MM/dd").cast("date"),
        "transactiontype": s.fold_diacritics(col(INCOME["transactiontype"])), "row_no": "row_no"})
