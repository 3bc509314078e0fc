"""Orders of the point of sale -> nhanhvnorders, nhanhvnorderdetails."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions import scalar as s
from orderloom.functions.rules import rule_cascade
from orderloom.operators.relational import map_codes, to_contract
from orderloom.sources.landed import explode_path, pick

SCHEMA = """
info STRUCT<id: STRING, createdAt: BIGINT, status: STRING, privateDescription: STRING, description: STRING,
            createdByName: STRING>,
shippingAddress STRUCT<name: STRING, mobile: STRING, cityId: STRING, districtId: STRING>,
carrier STRUCT<name: STRING, carrierCode: STRING, sendCarrierAt: BIGINT>,
channel STRUCT<trafficSource: STRING, saleChannel: STRING>,
payment STRUCT<transfer: STRUCT<amount: BIGINT>, deposit: STRUCT<amount: BIGINT>>,
products ARRAY<STRUCT<code: STRING, barcode: STRING, price: BIGINT, discountAmount: BIGINT, quantity: BIGINT>>
"""
# Order sources end with one of these where the order follows another one.
FOLLOW_UPS = ("don doi", "bo sung", "len lai", "don tach")
FIRST = "di moi"
# How notes name an earlier order, an earlier sku and a wrong product.
OLD_ID = r"(\b\d{9}\b)"
OLD_SKU = r"(mdu[1-9]{4})"
WRONG_PRODUCT = r"DI\s*=\s*[a-zA-Z]{3}"


def clean_pos_orders(orders: DataFrame, maps: dict[str, DataFrame] | None = None, old_sku: str = OLD_SKU) -> DataFrame:
    """Headers: folded texts, parent and child source, prepaid money, earlier ids found in notes.

    maps    code tables (code, label[, order]) for orderstatus, platform, customer_cityaddress and
            customer_districtaddress; unmapped codes become NULL
    """
    flat = pick(orders, {
        "orderid": "info.id", "created": "info.createdAt", "customername": "shippingAddress.name",
        "customerphonenumber": "shippingAddress.mobile", "customer_cityaddress": "shippingAddress.cityId",
        "customer_districtaddress": "shippingAddress.districtId", "deliverybrand": "carrier.name",
        "trackingnumber": "carrier.carrierCode", "orderstatus": "info.status", "origin": "channel.trafficSource",
        "platform": "channel.saleChannel", "sent": "carrier.sendCarrierAt", "transfer": "payment.transfer.amount",
        "deposit": "payment.deposit.amount", "internalnote": "info.privateDescription",
        "customernote": "info.description", "created_byperson": "info.createdByName",
    }, defaults={"transfer": 0, "deposit": 0})
    texts = ("customername", "customerphonenumber", "deliverybrand", "origin", "internalnote", "customernote",
             "created_byperson")
    flat = flat.withColumns({c: s.fold_diacritics(F.lower(c)) for c in texts})
    origin = F.col("origin")
    follows = [(origin.endswith(text), text) for text in FOLLOW_UPS]
    flat = flat.withColumn("orderparentsource", rule_cascade(follows[::-1], FIRST))
    child = F.when(F.col("orderparentsource") == FIRST, origin).otherwise(s.head_before_last(origin))
    out = to_contract(flat, {
        "orderid": "orderid", "created_at": s.local_time(F.col("created")), "customername": "customername",
        "customerphonenumber": "customerphonenumber", "customer_cityaddress": "customer_cityaddress",
        "customer_districtaddress": "customer_districtaddress", "deliverybrand": "deliverybrand",
        "trackingnumber": "trackingnumber", "orderstatus": "orderstatus", "orderparentsource": "orderparentsource",
        "ordersource": s.strip_ws(child), "platform": "platform",
        "senddelivery_at": s.local_time(s.null_if(F.col("sent"), 0)),
        "cod_prepaid": F.col("deposit") + F.col("transfer"), "created_byperson": "created_byperson",
        "internalnote": s.truncate_to(F.col("internalnote"), 255),
        "customernote": s.truncate_to(F.col("customernote"), 255),
        "previousid_internalnote": s.extract(F.col("internalnote"), OLD_ID),
        "previousid_customernote": F.upper(s.extract(F.col("customernote"), old_sku)),
        "is_wrongproduct": s.matches(F.col("internalnote"), WRONG_PRODUCT, ignore_case=True)})
    for name, mapping in (maps or {}).items():
        out = map_codes(out, name, mapping, mapping.columns[2] if len(mapping.columns) > 2 else None)
    return out


def clean_pos_lines(orders: DataFrame) -> DataFrame:
    """One row per product of an order."""
    items = explode_path(orders, "products", [F.col("info.id").alias("orderid")])
    sku = F.upper(F.coalesce("item.code", F.lit("")))
    return to_contract(items, {
        "productid": sku, "orderid": "orderid", "productbarcode": F.col("item.barcode"),
        "parentproductid": s.sku_prefix(sku), "price": F.col("item.price"),
        "discount_allproduct": F.col("item.discountAmount"), "quantity": F.col("item.quantity")})
