"""Columns, types and keys of the staging tables, the star and the log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TYPES = {
    "string": T.StringType(), "bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(),
    "date": T.DateType(), "time": T.TimestampNTZType(), "money": T.DecimalType(25, 10),
}


def schema(**cols: str) -> T.StructType:
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in cols.items()])


def _of(kind: str, *names: str) -> dict[str, str]:
    return dict.fromkeys(names, kind)


STAMP = {"dw_updatedat": "time"}

# The columns of the staging tables, and further down those of the star.
LAKE: dict[str, T.StructType] = {
    "nhanhvnorders": schema(
        orderid="string", created_at="time",
        **_of("string", "customername", "customerphonenumber", "customer_cityaddress", "customer_districtaddress",
                        "deliverybrand", "trackingnumber", "orderstatus", "orderparentsource", "ordersource", "platform"),
        senddelivery_at="time", cod_prepaid="bigint",
        **_of("string", "created_byperson", "internalnote", "customernote", "previousid_internalnote",
                        "previousid_customernote"),
        is_wrongproduct="boolean", **STAMP,
    ),
    "nhanhvnorderdetails": schema(
        **_of("string", "productid", "orderid", "productbarcode", "parentproductid"),
        **_of("bigint", "price", "discount_allproduct", "quantity"), **STAMP,
    ),
    "deliveryorders": schema(
        **_of("string", "delivery_orderid", "shop_orderid", "orderstatus"),
        **_of("bigint", "cod_collected", "cod_declared", "shippingcost"),
        **_of("time", "createdat", "pickupat", "completedat"),
        courier="string", compensationvalue="bigint", courieraccount="string", **STAMP,
    ),
    "customerbanks": schema(
        bank_surrogateid="string", notedate="date", orderid="string", customerphonenumber="string",
        bankvalue="double", **_of("string", "verifybyperson", "ftcode", "note"), **STAMP,
    ),
    "returnedorders_scan": schema(
        scan_surrogateid="string", scanat="date", delivery_orderid="string", productid="string", **STAMP,
    ),
    "delivery_reconciliation": schema(
        sessionid="string", delivery_orderid="string", reconciliation_value="bigint", reconciliation_at="time",
        courier="string", reconciliation_content="string", **STAMP,
    ),
    "handle_deliveryorders": schema(
        delivery_orderid="string", scan_deliveryorder_at="date",
        **_of("string", "handleteam_note1", "handleteam_note2", "handleteam_note3"), **STAMP,
    ),
    "shopeeorders": schema(
        **_of("string", "orderid", "packageid", "courier"), **_of("time", "createdat", "pickupat", "completedat"),
        **_of("string", "orderstatus", "cancel_reason", "buyer_accountname", "returned_orderids", "buyer_paymentmethod"),
        **_of("bigint", "collectedvalue_theory", "buyerpaidvalue", "shippingcost", "shippingcostdiscounted_byplatform",
                        "shippingcostdiscounted_byseller"),
        **_of("string", "delivery_orderid", "shopname"), **STAMP,
    ),
    "shopeeorderdetails": schema(
        **_of("string", "orderid", "product_skuid", "orderproduct_id", "productid", "productname", "product_skuname"),
        quantity="bigint", displayprice="bigint", realprice="double",
        shopdiscount_allquantities="bigint", shopeediscount_allquantities="bigint", **STAMP,
    ),
    "tiktokorders": schema(
        orderid="string", **_of("time", "create_time", "collection_time", "delivery_time", "cancel_time"),
        **_of("string", "status", "cancel_reason", "buyer_email", "payment_method_name"),
        **_of("bigint", "original_shipping_fee", "actual_shipping_fee", "shipping_fee_platform_discount",
                        "shipping_fee_seller_discount"),
        **_of("string", "tracking_number", "shipping_provider", "buyeraddress_lv0", "buyeraddress_lv1", "buyeraddress_lv2",
                        "return_reason", "returned_trackingnumber", "returnstatus"),
        **_of("bigint", "returnshippingfee_paidbybuyer", "returnshippingfee_paidbyplatform",
                        "returnshippingfee_paidbyseller"),
        shopname="string", **STAMP,
    ),
    "tiktokorderdetails": schema(
        **_of("string", "orderid", "product_skuid", "productid", "productname", "product_skuname"),
        **_of("bigint", "displayprice", "quantity", "shopdiscount_allquantities", "tiktokdiscount_allquantities"), **STAMP,
    ),
    "tiktok_reconciliation": schema(
        order_or_statement_id="string", transactiontime="date", transactiontype="string",
        **_of("bigint", "settlement_amount", "revenue", "subtotal_after_discount", "subtotal_before_discount",
                        "seller_discount", "refund_subtotal_after_discount", "refund_subtotal_before_discount",
                        "refundforseller_amount", "totalfee"),
        **STAMP,
    ),
}

LAKE_KEYS: dict[str, list[str]] = {
    "nhanhvnorders": ["orderid"],
    "nhanhvnorderdetails": ["orderid", "productid"],
    "deliveryorders": ["delivery_orderid"],
    "customerbanks": ["bank_surrogateid"],
    "returnedorders_scan": ["scan_surrogateid"],
    "delivery_reconciliation": ["delivery_orderid", "sessionid"],
    "handle_deliveryorders": ["delivery_orderid"],
    "shopeeorders": ["orderid"],
    "shopeeorderdetails": ["orderid", "product_skuid", "orderproduct_id"],
    "tiktokorders": ["orderid"],
    "tiktokorderdetails": ["orderid", "product_skuid"],
    "tiktok_reconciliation": ["order_or_statement_id", "transactiontime"],
}

# How a batch is merged into each staging table.
LAKE_MODES: dict[str, str] = {
    name: "changed" if name in ("deliveryorders", "customerbanks", "returnedorders_scan", "delivery_reconciliation",
                                "tiktok_reconciliation")
    else "coalesce" if name == "handle_deliveryorders" else "replace"
    for name in LAKE
}

# Declared text lengths of the staging keys and notes; longer text must not be loaded.
TEXT_LIMITS: dict[str, dict[str, int]] = {
    "nhanhvnorders": {"orderid": 40, "customername": 200, "internalnote": 255, "customernote": 255, "ordersource": 100},
    "deliveryorders": {"delivery_orderid": 40, "orderstatus": 40},
    "customerbanks": {"bank_surrogateid": 40, "orderid": 160, "note": 255},
    "delivery_reconciliation": {"sessionid": 60, "delivery_orderid": 100, "reconciliation_content": 255},
    "handle_deliveryorders": {"handleteam_note1": 255, "handleteam_note2": 255, "handleteam_note3": 255},
    "tiktokorders": {"returned_trackingnumber": 50, "cancel_reason": 200},
}

BASE_MEASURES = (
    "baseorder_shippingfee", "baseorder_cod_collected_allquantity",
    "baseorder_codbank_collected_allquantity", "baseorder_codprepaid_allquantity",
    "baseorder_positive_reconciliation_allquantity", "baseorder_negative_reconciliation_allquantity",
)

STAR: dict[str, T.StructType] = {
    "dim_order": schema(
        orderid="string", createdat="time",
        **_of("string", "status", "parentsource", "source", "platform", "created_byperson", "cancel_reason",
                        "return_reason"),
        is_wrongproduct="boolean", lastupdateat="time",
    ),
    "dim_delivery": schema(
        **_of("string", "trackingnumber", "courier", "courieraccount", "delivery_status"),
        **_of("time", "createdat", "pickupat", "deliveryat"), scan_deliveryorder_at="date",
        **_of("string", "handleteam_note1", "handleteam_note2", "handleteam_note3"), lastupdateat="time",
    ),
    "dim_customer": schema(
        **_of("string", "customer_surrogateid", "phonenumber", "name", "ecommerce_name", "country", "city", "district"),
    ),
    "dim_product": schema(
        productid="string", retailprice="bigint",
        **_of("string", "cate_purpose", "cate_color", "cate_fabric", "cate_collar", "cate_sleeve", "cate_sleevelong",
                        "cate_dresstype", "cate_fabricpattern"),
    ),
    "dim_reconciliation": schema(
        order_or_delivery_id="string", max_transactiontime="time", min_transactiontime="time",
        **_of("string", "all_sessionid", "all_transactiontime", "allcontent"),
    ),
    "fact_orderdetails": schema(
        **_of("string", "orderid", "productid", "parentproductid", "deliveryid", "customer_surrogateid",
                        "transaction_orderid"),
        **_of("double", *BASE_MEASURES), shippingfee="money",
        quantity="bigint", originalprice="bigint", discountamount_allquantity="double",
        extradiscountamount_allquantity="money",
        **_of("money", "cod_collected_allquantity", "codbank_collected_allquantity", "codprepaid_allquantity"),
        return_quantity="bigint",
        **_of("money", "positive_reconciliation_allquantity", "negative_reconciliation_allquantity"),
        finalstatus="string", lastupdateat="time",
    ),
}

STAR_KEYS: dict[str, list[str]] = {
    "dim_order": ["orderid"],
    "dim_delivery": ["trackingnumber"],
    "dim_customer": ["customer_surrogateid"],
    "dim_product": ["productid"],
    "dim_reconciliation": ["order_or_delivery_id"],
    "fact_orderdetails": ["orderid", "productid"],
}

# fact column -> (dimension, its key)
STAR_REFERENCES: dict[str, tuple[str, str]] = {
    "orderid": ("dim_order", "orderid"),
    "deliveryid": ("dim_delivery", "trackingnumber"),
    "customer_surrogateid": ("dim_customer", "customer_surrogateid"),
    "parentproductid": ("dim_product", "productid"),
    "transaction_orderid": ("dim_reconciliation", "order_or_delivery_id"),
}


def empty(spark: SparkSession, table: str) -> DataFrame:
    """A table without rows, known as such to Catalyst, which then leaves out the joins with it."""
    return spark.createDataFrame([], {**LAKE, **STAR}[table]).filter(F.lit(False))


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns of a table in its order and types; columns the frame lacks are NULL."""
    have = {f.name: f.dataType for f in df.schema.fields}

    def column(field: T.StructField):
        if have.get(field.name) == field.dataType:
            return field.name
        return (F.col(field.name) if field.name in have else F.lit(None)).cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in {**LAKE, **STAR}[table].fields])
