"""Staging tables and fact lines played by the shared tables: orders as headers of three channels,
line items as product lines, parcels and returns, events as settlements, transfers and notes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.rules import rule_cascade
from orderloom.operators.relational import lookup, union_all
from orderloom.plans.registry import cents, whole
from orderloom.schemas import LAKE, conform

SELF = "Tu Van Chuyen"


def _text(prefix: str, col: str):
    return F.concat(F.lit(prefix), F.col(col).cast("string"))


def _state(flag: str, status: str):
    """Two letters as one number, which hash aggregation can keep the smallest of."""
    return F.ascii(flag) * 100 + F.ascii(status)


def _by_order(lineitem: DataFrame) -> DataFrame:
    """Line items with their order, for products per order and for joins by order: one shuffle serves both."""
    return lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus").repartition("l_orderkey")


def outcome_frames(t) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(fact lines, order dimension, delivery dimension) that reach every outcome rule."""
    key = F.col("l_orderkey")
    lines = _by_order(t.lineitem).groupBy("l_orderkey", "l_partkey").agg(
        F.when(key % 7 == 0, F.lit(1)).otherwise(F.sum("l_quantity")).cast("bigint").alias("quantity"),
        F.min(F.floor(F.col("l_extendedprice") / F.col("l_quantity"))).cast("bigint").alias("originalprice"),
        F.min(_state("l_returnflag", "l_linestatus")).alias("state"),
        F.min(cents("l_discount")).alias("off"))
    lines = lookup(lines, t.orders, {"l_orderkey": "o_orderkey"}, ["o_totalprice", "o_custkey"], aligned=True)
    key, qty, off = F.col("l_orderkey"), F.col("quantity"), F.col("off")
    amount = whole("o_totalprice").cast("double")
    zero = F.lit(0.0)
    fact = lines.select(
        key.alias("orderid"), F.col("l_partkey").alias("productid"),
        F.concat_ws("-", key, "state").alias("deliveryid"), "quantity", "originalprice",
        (off * 100).cast("double").alias("discountamount_allquantity"), off.cast("double").alias(
            "extradiscountamount_allquantity"),
        F.when(off >= 8, qty).when(off >= 5, F.floor(qty / 2)).otherwise(F.lit(0)).cast("bigint").alias(
            "return_quantity"),
        F.when(key % 5 == 4, amount).when(key % 5 == 3, F.lit(-1.0)).otherwise(zero).alias(
            "baseorder_cod_collected_allquantity"),
        F.when(key % 5 == 2, amount).otherwise(zero).alias("baseorder_codbank_collected_allquantity"),
        F.when(key % 5 == 1, F.lit(30_000.0)).otherwise(F.when(key % 5 == 2, F.lit(999.0)).otherwise(zero)).alias(
            "baseorder_codprepaid_allquantity"),
        (F.col("o_custkey") + 20_000).cast("double").alias("baseorder_shippingfee"),
        amount.alias("baseorder_positive_reconciliation_allquantity"),
        (-F.col("o_custkey")).cast("double").alias("baseorder_negative_reconciliation_allquantity"),
        *[F.lit(None).cast("double").alias(c) for c in (
            "shippingfee", "cod_collected_allquantity", "codbank_collected_allquantity", "codprepaid_allquantity",
            "positive_reconciliation_allquantity", "negative_reconciliation_allquantity")],
        F.lit(None).cast("string").alias("finalstatus"),
    )
    priority, status, number = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_orderkey")
    parent = rule_cascade([
        (priority == "1-URGENT", "don doi"), (priority == "2-HIGH", "bo sung"),
        (priority == "4-NOT SPECIFIED", F.lit(None).cast("string"))], "di moi")
    dim_order = t.orders.select(
        number.alias("orderid"), parent.alias("parentsource"),
        rule_cascade([(status == "F", "thanh cong"), (status == "P", "dang chuyen hoan"),
                      (number % 2 == 0, "khach huy")], "CANCELLED").alias("status"),
        F.when(F.col("o_custkey") % 3 == 0, "x").alias("return_reason"),
        F.when(priority == "4-NOT SPECIFIED", "Shopee shops").otherwise("pos").alias("platform"))
    number, state = F.col("l_orderkey"), F.col("state")
    parcels = t.lineitem.select("l_orderkey", _state("l_returnflag", "l_linestatus").alias("state")).distinct()
    dim_delivery = parcels.select(
        F.concat_ws("-", number, state).alias("trackingnumber"),
        F.when(number % 4 == 0, F.lit(SELF)).when(number % 4 != 1, F.lit("Courier")).alias("courier"),
        rule_cascade([
            (state >= 8200, "Da tra hang"), (state == 6570, "Da giao hang"), (state == 6579, "Huy"),
            (state == 7870, "COMPLETED")], "Dang giao").alias("delivery_status"))
    return fact, dim_order, dim_delivery


OUTCOME_SQL = """line AS (SELECT l_orderkey, l_partkey,
    CASE WHEN l_orderkey % 7 = 0 THEN 1 ELSE cast(sum(l_quantity) AS bigint) END AS qty,
    min(cast(floor(l_extendedprice / l_quantity) AS bigint)) AS price, min(l_returnflag || l_linestatus) AS state,
    min(cast(round(l_discount * 100) AS bigint)) AS off
  FROM lineitem GROUP BY l_orderkey, l_partkey),
fact AS (SELECT line.*, o_custkey, o_orderpriority AS priority, o_orderstatus,
    CASE WHEN off >= 8 THEN qty WHEN off >= 5 THEN qty // 2 ELSE 0 END AS back,
    CASE l_orderkey % 5 WHEN 4 THEN round(o_totalprice) WHEN 3 THEN -1.0 ELSE 0.0 END AS cod,
    CASE WHEN l_orderkey % 5 = 2 THEN round(o_totalprice) ELSE 0.0 END AS bank,
    CASE l_orderkey % 5 WHEN 1 THEN 30000.0 WHEN 2 THEN 999.0 ELSE 0.0 END AS prepaid,
    round(o_totalprice) AS whole, qty * price - off * 100 - off AS worth,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'don doi' WHEN '2-HIGH' THEN 'bo sung' WHEN '4-NOT SPECIFIED' THEN NULL
      ELSE 'di moi' END AS parent,
    CASE o_orderstatus WHEN 'F' THEN 'thanh cong' WHEN 'P' THEN 'dang chuyen hoan'
      ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'khach huy' ELSE 'CANCELLED' END END AS status,
    o_custkey % 3 = 0 AS has_reason,
    CASE WHEN l_orderkey % 4 = 0 THEN 'self' WHEN l_orderkey % 4 = 1 THEN NULL ELSE 'courier' END AS courier,
    CASE WHEN state[1] = 'R' THEN 'back' WHEN state = 'AF' THEN 'given' WHEN state = 'AO' THEN 'Huy'
      WHEN state = 'NF' THEN 'COMPLETED' ELSE 'Dang giao' END AS parcel
  FROM line JOIN orders ON l_orderkey = o_orderkey),
summed AS (SELECT *, sum(qty) OVER (PARTITION BY l_orderkey) AS total_qty, sum(worth) OVER (PARTITION BY l_orderkey) AS total,
    cod + CASE WHEN bank = 0 THEN prepaid ELSE bank END AS paid,
    coalesce(courier, 'self') = 'self' AS by_self, courier = 'courier' AS by_courier FROM fact),
judged AS (SELECT *, CASE
    WHEN by_courier AND parcel IN ('back', 'given') AND parent IS NOT NULL THEN CASE
      WHEN parent = 'bo sung' THEN 'Thanh cong'
      WHEN paid <= 0 THEN 'Hoan'
      WHEN paid <= 30000 THEN 'Hoan thu ship'
      WHEN parent = 'don doi' THEN 'Hoan mot phan'
      WHEN paid >= total THEN CASE parcel WHEN 'back' THEN 'Hoan' ELSE 'Thanh cong' END
      WHEN back = 0 THEN 'Thanh cong' WHEN back >= qty THEN 'Hoan' ELSE 'Hoan mot phan' END
    WHEN by_courier AND parcel = 'Huy' THEN 'Huy'
    WHEN by_self AND status IN ('thanh cong', 'dang chuyen hoan') AND parent IS NOT NULL THEN CASE
      WHEN parent = 'bo sung' THEN 'Thanh cong'
      WHEN paid <= 0 THEN 'Hoan'
      WHEN paid <= 30000 THEN 'Hoan thu ship'
      WHEN parent = 'don doi' THEN 'Hoan thu ship'
      WHEN paid >= total THEN 'Thanh cong'
      WHEN back = 0 THEN 'Thanh cong' WHEN back >= qty THEN 'Hoan' ELSE 'Hoan mot phan' END
    WHEN by_self AND status = 'khach huy' THEN 'Huy'
    WHEN parent IS NULL AND parcel = 'COMPLETED' AND NOT has_reason THEN 'Thanh cong'
    WHEN parent IS NULL AND parcel = 'COMPLETED' AND total_qty = 1 THEN 'Hoan'
    WHEN parent IS NULL AND parcel = 'COMPLETED' AND total_qty > 1 THEN
      CASE WHEN back >= qty THEN 'Hoan' WHEN back > 0 THEN 'Hoan mot phan' ELSE 'Thanh cong' END
    WHEN parent IS NULL AND status = 'CANCELLED' THEN 'Huy'
    ELSE 'Pending' END AS finalstatus FROM summed),
valued AS (SELECT *, CASE
    WHEN finalstatus IN ('Huy', 'Pending', 'Hoan') THEN 0.0
    WHEN finalstatus IN ('Thanh cong', 'Hoan thu ship') THEN cast(worth AS double)
    WHEN qty > back THEN cast((qty - back) * price AS double)
      - cast(off * 100 AS double) * (cast(qty - back AS double) / cast(qty AS double))
      - cast(off AS double) * (cast(qty - back AS double) / cast(qty AS double))
    ELSE 0.0 END AS success FROM judged),
settled AS (SELECT *, cast(cast(success AS decimal(28,10)) AS double) AS kept,
    cast(sum(cast(success AS decimal(28,10))) OVER (PARTITION BY l_orderkey) AS double) AS all_kept FROM valued)"""


def staging(t, stage=None) -> dict[str, DataFrame]:
    """All staging tables, derived from the shared tables.

    stage   writes the product lines, from which four of the tables are made, and the orders with their buyers, from which
            six are made, once each
    """
    t.spread("customer", "orders", "lineitem", "events")
    orders = lookup(t.orders, t.customer, {"o_custkey": "c_custkey"}, ["c_name", "c_mktsegment", "c_nationkey"])
    orders = lookup(orders, t.nation, {"c_nationkey": "n_nationkey"}, ["n_name"])
    number, at = F.col("o_orderkey"), F.col("o_orderdate")
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    known = F.col("c_mktsegment") != "HOUSEHOLD"
    by_hand, shopee, tiktok = priority == "2-HIGH", priority == "4-NOT SPECIFIED", priority == "5-LOW"
    pos = ~shopee & ~tiktok
    channel = F.when(pos, 0).when(shopee, 1).when(tiktok, 2)  # lines need no more of their order
    price = whole("o_totalprice")
    if stage is not None:
        orders = stage(orders)
    # One shuffle by order serves the products and their headers. A line without an order is sold nowhere and no scan finds it.
    lines = t.lineitem.filter(F.col("l_orderkey").isNotNull()).select(
        "l_orderkey", "l_partkey", "l_quantity", F.floor(F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), "l_suppkey", "l_linenumber",
        cents("l_discount").alias("off"), "l_shipdate", (F.col("l_returnflag") == "R").alias("returned")).repartition("l_orderkey")
    lines = lines.groupBy("l_orderkey", "l_partkey").agg(
        F.sum("l_quantity").cast("bigint").alias("quantity"), F.min("price").cast("bigint").alias("price"),
        F.min("l_suppkey").alias("supplier"), F.min("l_linenumber").alias("line"),
        F.max("off").alias("off"), F.max("l_shipdate").alias("shipped"), F.bool_or("returned").alias("returned"))
    lines = lookup(lines, t.orders.select("o_orderkey", channel.alias("channel")), {"l_orderkey": "o_orderkey"}, ["channel"], aligned=True)
    if stage is not None:
        lines = stage(lines)
    sku = F.concat(F.lit("P"), "l_partkey", F.lit("-"), "supplier")
    returned = lines.filter("returned").select("l_orderkey", "l_partkey", "supplier", "channel")
    lines = lines.withColumn("sku", sku)
    pos_line, shopee_line, tiktok_line = (F.col("channel") == i for i in range(3))

    out = {
        "nhanhvnorders": orders.filter(pos).select(
            _text("N", "o_orderkey").alias("orderid"), at.alias("created_at"), F.col("c_name").alias("customername"),
            F.when(known, _text("0", "o_custkey")).alias("customerphonenumber"),
            F.when(known, F.col("n_name")).alias("customer_cityaddress"),
            F.when(by_hand, SELF).otherwise("GHN").alias("deliverybrand"),
            F.when(~by_hand, _text("T", "o_orderkey")).alias("trackingnumber"),
            F.when(status == "F", "thanh cong").when(status == "O", "khach huy").when(
                priority == "3-MEDIUM", "don moi").otherwise("dang chuyen hoan").alias("orderstatus"),
            F.when(priority == "1-URGENT", "don doi").when(by_hand & (status == "P"), "bo sung").otherwise(
                "di moi").alias("orderparentsource"),
            F.lit("fanpage").alias("ordersource"), F.lit("facebook").alias("platform"),
            F.when(priority == "1-URGENT", F.floor(price / 10)).alias("cod_prepaid"),
            F.lit(False).alias("is_wrongproduct"), at.alias("dw_updatedat")),
        "nhanhvnorderdetails": lines.filter(pos_line).select(
            _text("N", "l_orderkey").alias("orderid"), F.col("sku").alias("productid"),
            F.substring_index("sku", "-", 1).alias("parentproductid"), "price",
            (F.col("off") * 100).alias("discount_allproduct"), "quantity", F.col("shipped").alias("dw_updatedat")),
        "deliveryorders": orders.filter((pos & ~by_hand & (status != "P")) | (by_hand & (status == "F"))).select(
            F.when(by_hand, _text("TVC_GGSHEET_N", "o_orderkey")).otherwise(_text("T", "o_orderkey")).alias(
                "delivery_orderid"),
            F.when(by_hand, "Da giao").when(status == "F", "Da giao hang").when(
                priority == "1-URGENT", "Huy").otherwise("Da tra hang").alias("orderstatus"),
            F.when(status == "F", price).otherwise(F.lit(30000)).alias("cod_collected"),
            (F.col("o_custkey") + 20000).alias("shippingcost"), at.alias("createdat"),
            F.date_add(at, 2).cast("timestamp_ntz").alias("completedat"),
            F.when(by_hand, SELF).otherwise("Giao Hang Nhanh").alias("courier"), F.lit(0).alias("compensationvalue"),
            F.lit("tk1").alias("courieraccount"), at.alias("dw_updatedat")),
        "customerbanks": t.events.filter("event_type IN ('purchase', 'signup')").select(
            _text("KB_", "event_id").alias("bank_surrogateid"), F.to_date("ts").alias("notedate"),
            F.when(F.col("event_type") == "purchase", _text("N", "event_id")).otherwise(_text("N", "user_id")).alias(
                "orderid"),
            whole(F.col("value") * 1000).cast("double").alias("bankvalue"), F.col("ts").alias("dw_updatedat")),
        "returnedorders_scan": lookup(
            t.lineitem.filter("l_returnflag = 'R'"), returned, ["l_orderkey", "l_partkey"], ["supplier", "channel"]
        ).select(
            F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey").alias("scan_surrogateid"),
            F.to_date("l_shipdate").alias("scanat"),
            F.when(shopee_line, _text("ST", "l_orderkey")).otherwise(_text("T", "l_orderkey")).alias("delivery_orderid"),
            sku.alias("productid"), F.col("l_shipdate").alias("dw_updatedat")),
        "delivery_reconciliation": t.events.filter("event_type IN ('click', 'view', 'error')").select(
            F.concat_ws("_", "event_type", "event_id").alias("sessionid"),
            F.concat(F.when(F.col("event_type") == "view", "S").otherwise("T"),
                     F.floor(F.col("event_id") / 2)).alias("delivery_orderid"),
            (whole(F.col("value") * 1000) * F.when(F.col("event_type") == "error", -1).otherwise(1)).cast(
                "bigint").alias("reconciliation_value"),
            F.col("ts").alias("reconciliation_at"), F.lit("Giao Hang Nhanh").alias("courier"),
            F.nullif("event_type", F.lit("error")).alias("reconciliation_content"), F.col("ts").alias("dw_updatedat")),
        "handle_deliveryorders": t.events.filter("event_type = 'signup'").select(
            _text("T", "event_id").alias("delivery_orderid"), F.to_date("ts").alias("scan_deliveryorder_at"),
            _text("goi ", "user_id").alias("handleteam_note1"), F.col("ts").alias("dw_updatedat")),
        "shopeeorders": orders.filter(shopee).select(
            _text("S", "o_orderkey").alias("orderid"), F.lit("SPX").alias("courier"), at.alias("createdat"),
            F.when(status == "F", F.date_add(at, 3).cast("timestamp_ntz")).alias("completedat"),
            F.when(status == "F", "COMPLETED").when(status == "O", "CANCELLED").otherwise("SHIPPED").alias("orderstatus"),
            F.when(status == "O", "doi y").alias("cancel_reason"), F.when(known, F.col("c_name")).alias("buyer_accountname"),
            F.when(F.col("c_mktsegment") == "BUILDING", "x").alias("returned_orderids"),
            F.when(status != "P", _text("ST", "o_orderkey")).alias("delivery_orderid"), F.lit("shop 1").alias("shopname"),
            at.alias("dw_updatedat")),
        "shopeeorderdetails": lines.filter(shopee_line).select(
            _text("S", "l_orderkey").alias("orderid"), F.col("sku").alias("product_skuid"),
            F.col("line").cast("string").alias("orderproduct_id"), "quantity", F.col("price").alias("displayprice"),
            (F.col("price") - F.col("off")).alias("realprice"), (F.col("off") * 10).alias("shopdiscount_allquantities"),
            F.col("shipped").alias("dw_updatedat")),
        "tiktokorders": orders.filter(tiktok).select(
            _text("K", "o_orderkey").alias("orderid"), at.alias("create_time"),
            F.when(status == "F", F.date_add(at, 4).cast("timestamp_ntz")).alias("delivery_time"),
            F.when(status == "O", F.date_add(at, 1).cast("timestamp_ntz")).alias("cancel_time"),
            F.when(status == "F", "COMPLETED").when(status == "O", "CANCELLED").otherwise("IN_TRANSIT").alias("status"),
            F.when(status == "O", "het hang").alias("cancel_reason"),
            F.when(known, F.concat("c_name", F.lit("@mail"))).alias("buyer_email"),
            _text("KT", "o_orderkey").alias("tracking_number"), F.lit("J&T").alias("shipping_provider"),
            F.lit("Viet Nam").alias("buyeraddress_lv0"), F.col("n_name").alias("buyeraddress_lv1"),
            F.when(F.col("c_mktsegment") == "MACHINERY", "vo").alias("return_reason"), F.lit("shop 2").alias("shopname"),
            at.alias("dw_updatedat")),
        "tiktokorderdetails": lines.filter(tiktok_line).select(
            _text("K", "l_orderkey").alias("orderid"), F.col("sku").alias("product_skuid"),
            F.col("price").alias("displayprice"), "quantity", (F.col("off") * 50).alias("shopdiscount_allquantities"),
            F.col("shipped").alias("dw_updatedat")),
        "tiktok_reconciliation": union_all(
            orders.filter(tiktok & (status != "P")).select(
                _text("K", "o_orderkey").alias("order_or_statement_id"), F.date_add(at, 10).alias("transactiontime"),
                price.alias("revenue"), (-F.floor(price / 10)).alias("totalfee"), at.alias("dw_updatedat")),
            orders.filter(tiktok & (status == "O")).select(
                _text("K", "o_orderkey").alias("order_or_statement_id"), F.date_add(at, 20).alias("transactiontime"),
                F.lit(0).cast("bigint").alias("revenue"), F.lit(-500).cast("bigint").alias("totalfee"),
                at.alias("dw_updatedat"))),
    }
    return {name: conform(out[name], name) for name in LAKE}


def catalogue(t) -> DataFrame:
    """Listed products: parts outside promotion, by parent sku."""
    return conform(t.part.filter("p_type <> 'PROMO'").select(
        _text("P", "p_partkey").alias("productid"), whole("p_retailprice").alias("retailprice"),
        F.col("p_type").alias("cate_purpose")), "dim_product")


STAGING_SQL = """buyer AS (SELECT orders.*, c_name, c_mktsegment, n_name, c_mktsegment <> 'HOUSEHOLD' AS known,
    cast(round(o_totalprice) AS bigint) AS whole
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey),
sold AS (SELECT l_orderkey, l_partkey, cast(sum(l_quantity) AS bigint) AS quantity,
    min(cast(floor(l_extendedprice / l_quantity) AS bigint)) AS price,
    max(cast(round(l_discount * 100) AS bigint)) AS off, 'P' || l_partkey || '-' || min(l_suppkey) AS sku,
    min(l_linenumber) AS line, max(l_shipdate) AS shipped
  FROM lineitem GROUP BY l_orderkey, l_partkey),
pos AS (SELECT *, 'N' || o_orderkey AS orderid,
    CASE WHEN o_orderpriority = '2-HIGH' THEN 'TVC_GGSHEET_N' || o_orderkey ELSE 'T' || o_orderkey END AS sent_as
  FROM buyer WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
  AND NOT (o_orderstatus = 'P' AND o_orderpriority = '3-MEDIUM')),
parcel AS (SELECT CASE WHEN o_orderpriority = '2-HIGH' THEN 'TVC_GGSHEET_N' || o_orderkey ELSE 'T' || o_orderkey END AS id,
    CASE WHEN o_orderpriority = '2-HIGH' THEN 'Da giao' WHEN o_orderstatus = 'F' THEN 'Da giao hang'
      WHEN o_orderpriority = '1-URGENT' THEN 'Huy' ELSE 'Da tra hang' END AS status,
    CASE WHEN o_orderstatus = 'F' THEN whole ELSE 30000 END AS cod, o_custkey + 20000 AS cost, o_orderdate AS ts_at,
    CASE WHEN o_orderpriority = '2-HIGH' THEN 'Tu Van Chuyen' ELSE 'Giao Hang Nhanh' END AS courier
  FROM buyer WHERE (o_orderpriority IN ('1-URGENT', '3-MEDIUM') AND o_orderstatus <> 'P')
    OR (o_orderpriority = '2-HIGH' AND o_orderstatus = 'F')),
note AS (SELECT 'T' || event_id AS id, cast(ts AS date) AS scan_at, 'goi ' || user_id AS note1, ts AS ts_at
  FROM events WHERE event_type = 'signup'),
shop AS (SELECT *, 'S' || o_orderkey AS orderid, CASE WHEN o_orderstatus <> 'P' THEN 'ST' || o_orderkey END AS sent_as,
    CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'CANCELLED' ELSE 'SHIPPED' END AS state
  FROM buyer WHERE o_orderpriority = '4-NOT SPECIFIED'),
tik AS (SELECT *, 'K' || o_orderkey AS orderid, 'KT' || o_orderkey AS sent_as,
    CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'CANCELLED' ELSE 'IN_TRANSIT' END AS state
  FROM buyer WHERE o_orderpriority = '5-LOW'),
settled AS (SELECT CASE event_type WHEN 'view' THEN 'S' ELSE 'T' END || (event_id // 2) AS id,
    event_type || '_' || event_id AS session, nullif(event_type, 'error') AS content, ts AS ts_at,
    cast(round(value * 1000) AS bigint) * CASE event_type WHEN 'error' THEN -1 ELSE 1 END AS amount
  FROM events WHERE event_type IN ('click', 'view', 'error')),
courier_sum AS (SELECT id, max(ts_at) AS max_at, min(ts_at) AS min_at, sum(CASE WHEN amount >= 0 THEN amount END) AS plus,
    sum(CASE WHEN amount < 0 THEN amount END) AS minus, string_agg(session, ',' ORDER BY ts_at, session) AS sessions,
    string_agg(strftime(ts_at, '%Y-%m-%d %H:%M:%S'), ',' ORDER BY ts_at, session) AS times,
    string_agg(content, ',' ORDER BY ts_at, session) AS contents FROM settled GROUP BY id),
paid_tik AS (SELECT orderid AS id, cast(o_orderdate AS date) + 10 AS ts_at, whole AS revenue, -(whole // 10) AS fee,
    o_orderdate AS stamp FROM tik WHERE o_orderstatus <> 'P'
  UNION ALL SELECT orderid, cast(o_orderdate AS date) + 20, 0, -500, o_orderdate FROM tik WHERE o_orderstatus = 'O'),
tik_sum AS (SELECT id, max(ts_at) AS max_at, min(ts_at) AS min_at, sum(revenue) AS plus, sum(fee) AS minus,
    string_agg(strftime(ts_at, '%Y-%m-%d'), ',' ORDER BY ts_at) AS times, max(stamp) AS stamp FROM paid_tik GROUP BY id),
delivery AS (SELECT coalesce(p.id, n.id) AS id, p.courier, p.status, p.ts_at AS createdat,
    CASE WHEN n.id IS NULL THEN p.ts_at ELSE n.ts_at END AS lastupdateat, CAST(p.ts_at AS date) + 2 AS done_at, p.id IS NOT NULL
    AS has_parcel, n.scan_at, n.note1 FROM parcel p FULL OUTER JOIN note n ON p.id = n.id
  UNION ALL SELECT sent_as, 'SPX', state, o_orderdate, o_orderdate,
    CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS date) + 3 END, false, NULL, NULL
    FROM shop WHERE sent_as IS NOT NULL
  UNION ALL SELECT sent_as, 'J&T', state, o_orderdate, o_orderdate, CASE o_orderstatus WHEN 'O' THEN
    CAST(o_orderdate AS date) + 1 WHEN 'F' THEN CAST(o_orderdate AS date) + 4 END, false, NULL, NULL FROM tik),
pos_sent AS (SELECT pos.*, delivery.id AS tracking FROM pos LEFT JOIN delivery ON sent_as = delivery.id),
fact0 AS (
  SELECT orderid, coalesce(sku, '') AS productid, coalesce(split_part(sku, '-', 1), '') AS parentproductid,
    tracking AS deliveryid, CASE WHEN known THEN '0' || o_custkey ELSE '' END || '_' || CASE WHEN known THEN n_name ELSE ''
    END AS customer, tracking AS transaction_orderid, 0.0 AS cod, 0.0 AS bank,
    CASE WHEN o_orderpriority = '1-URGENT' THEN cast(whole // 10 AS double) ELSE 0.0 END AS prepaid,
    coalesce(quantity, 0) AS quantity, coalesce(price, 0) AS price, cast(coalesce(off * 100, 0) AS double) AS off,
    0.0 AS extra, o_orderdate AS ts_at, 'pos' AS channel FROM pos_sent LEFT JOIN sold ON o_orderkey = l_orderkey
  UNION ALL
  SELECT orderid, sku || '_' || line, split_part(sku, '-', 1), sent_as, CASE WHEN known THEN c_name ELSE '' END, orderid,
    cast((price - off) * quantity - off * 10 AS double), 0.0, 0.0, quantity, price, cast(off AS double), off * 10.0,
    o_orderdate, 'shop' FROM shop JOIN sold ON o_orderkey = l_orderkey
  UNION ALL
  SELECT orderid, sku, split_part(sku, '-', 1), sent_as, CASE WHEN known THEN c_name || '@mail' ELSE '' END || '_' || n_name,
    orderid, cast(price * quantity - off * 50 AS double), 0.0, 0.0, quantity, price, cast(off * 50 AS double), 0.0,
    o_orderdate, 'shop' FROM tik JOIN sold ON o_orderkey = l_orderkey)"""

FACT_SQL = """bank_sum AS (SELECT CASE event_type WHEN 'purchase' THEN 'N' || event_id ELSE 'N' || user_id END AS id,
    sum(round(value * 1000)) AS value, max(ts) AS ts_at FROM events WHERE event_type IN ('purchase', 'signup') GROUP BY 1),
scan_sum AS (SELECT CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'ST' ELSE 'T' END || l.l_orderkey AS id, sku,
    count(*) AS n, max(l.l_shipdate) AS ts_at
  FROM lineitem l JOIN sold ON l.l_orderkey = sold.l_orderkey AND l.l_partkey = sold.l_partkey
  JOIN orders ON l.l_orderkey = o_orderkey WHERE l.l_returnflag = 'R' GROUP BY ALL),
fact1 AS (SELECT f.orderid, f.productid, f.parentproductid, f.deliveryid, f.customer, f.transaction_orderid, f.channel,
    f.quantity, f.price, f.off, f.extra, f.prepaid,
    CASE WHEN p.id IS NULL THEN 0.0 WHEN p.status = 'Huy' THEN 0.0 ELSE cast(p.cost AS double) END AS ship,
    CASE WHEN p.id IS NULL THEN f.cod WHEN p.status IN ('Huy', 'Da giao') THEN 0.0 ELSE cast(p.cod AS double) END AS cod,
    coalesce(b.value, f.bank) AS bank, cast(coalesce(c.plus, t.plus, 0) AS double) AS plus,
    cast(coalesce(c.minus, t.minus, 0) AS double) AS minus, coalesce(s.n, 0) AS back,
    greatest(f.ts_at, coalesce(p.ts_at, f.ts_at), coalesce(b.ts_at, f.ts_at), coalesce(c.max_at, f.ts_at), coalesce(t.stamp, f.ts_at),
      coalesce(s.ts_at, f.ts_at)) AS ts_at
  FROM fact0 f LEFT JOIN parcel p ON f.deliveryid = p.id LEFT JOIN bank_sum b ON f.orderid = b.id
  LEFT JOIN courier_sum c ON f.transaction_orderid = c.id LEFT JOIN tik_sum t ON f.transaction_orderid = t.id
  LEFT JOIN scan_sum s ON f.deliveryid = s.id AND split_part(f.productid, '_', 1) = s.sku),
header AS (SELECT orderid, CASE WHEN o_orderpriority = '1-URGENT' THEN 'don doi'
      WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' THEN 'bo sung' ELSE 'di moi' END AS parent,
    CASE o_orderstatus WHEN 'F' THEN 'thanh cong' WHEN 'O' THEN 'khach huy' ELSE 'dang chuyen hoan' END AS status,
    false AS has_reason, o_orderdate, 'facebook' AS platform FROM pos
  UNION ALL SELECT orderid, NULL, state, c_mktsegment = 'BUILDING', o_orderdate, 'Shopee shops' FROM shop
  UNION ALL SELECT orderid, NULL, state, c_mktsegment = 'MACHINERY', o_orderdate, 'Tiktok shops' FROM tik),
fact2 AS (SELECT f.*, h.parent, h.status AS order_status, h.has_reason, h.platform, h.o_orderdate, d.courier,
    d.status AS parcel, cod + CASE WHEN bank = 0 THEN prepaid ELSE bank END AS paid,
    quantity * price - off - extra AS worth, sum(quantity) OVER w AS total_qty,
    sum(quantity * price - off - extra) OVER w AS total
  FROM fact1 f LEFT JOIN header h ON f.orderid = h.orderid LEFT JOIN delivery d ON f.deliveryid = d.id
  WINDOW w AS (PARTITION BY f.orderid)),
fact3 AS (SELECT *, CASE
    WHEN courier <> 'Tu Van Chuyen' AND parcel IN ('Da giao hang', 'Da tra hang') AND parent IS NOT NULL THEN CASE
      WHEN parent = 'bo sung' THEN 'Thanh cong' WHEN paid <= 0 THEN 'Hoan' WHEN paid <= 30000 THEN 'Hoan thu ship'
      WHEN parent = 'don doi' THEN 'Hoan mot phan'
      WHEN paid >= total THEN CASE parcel WHEN 'Da tra hang' THEN 'Hoan' ELSE 'Thanh cong' END
      WHEN back = 0 THEN 'Thanh cong' WHEN back >= quantity THEN 'Hoan' ELSE 'Hoan mot phan' END
    WHEN courier <> 'Tu Van Chuyen' AND parcel IN ('Huy', 'CANCELLED') THEN 'Huy'
    WHEN coalesce(courier, 'Tu Van Chuyen') = 'Tu Van Chuyen' AND order_status IN ('thanh cong', 'dang chuyen hoan')
      AND parent IS NOT NULL THEN CASE
      WHEN parent = 'bo sung' THEN 'Thanh cong' WHEN paid <= 0 THEN 'Hoan' WHEN paid <= 30000 THEN 'Hoan thu ship'
      WHEN parent = 'don doi' THEN 'Hoan thu ship' WHEN paid >= total THEN 'Thanh cong'
      WHEN back = 0 THEN 'Thanh cong' WHEN back >= quantity THEN 'Hoan' ELSE 'Hoan mot phan' END
    WHEN coalesce(courier, 'Tu Van Chuyen') = 'Tu Van Chuyen' AND order_status = 'khach huy' THEN 'Huy'
    WHEN parent IS NULL AND parcel = 'COMPLETED' AND NOT has_reason THEN 'Thanh cong'
    WHEN parent IS NULL AND parcel = 'COMPLETED' AND total_qty = 1 THEN 'Hoan'
    WHEN parent IS NULL AND parcel = 'COMPLETED' AND total_qty > 1 THEN
      CASE WHEN back >= quantity THEN 'Hoan' WHEN back > 0 THEN 'Hoan mot phan' ELSE 'Thanh cong' END
    WHEN parent IS NULL AND (order_status = 'CANCELLED' OR parcel = 'CANCELLED') THEN 'Huy'
    ELSE 'Pending' END AS finalstatus FROM fact2),
fact4 AS (SELECT *, CASE
    WHEN finalstatus IN ('Huy', 'Pending', 'Hoan') THEN 0.0
    WHEN finalstatus IN ('Thanh cong', 'Hoan thu ship') THEN worth
    WHEN quantity > back THEN cast((quantity - back) * price AS double)
      - off * (cast(quantity - back AS double) / cast(quantity AS double))
      - extra * (cast(quantity - back AS double) / cast(quantity AS double))
    ELSE 0.0 END AS success FROM fact3),
fact5 AS (SELECT *, cast(cast(success AS decimal(28,10)) AS double) AS kept,
    cast(sum(cast(success AS decimal(28,10))) OVER (PARTITION BY orderid) AS double) AS all_kept FROM fact4)"""


def share_sql(amount: str, part: str, whole: str) -> str:
    """Share of an amount as the library computes it."""
    return (f"{amount} * CASE WHEN {whole} = 0 THEN 0.0 ELSE cast({part} AS double) / cast({whole} AS double) END")
