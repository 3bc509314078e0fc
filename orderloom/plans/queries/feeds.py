"""The feed cleaners over feed-shaped frames made of the shared tables."""

from datetime import date

from pyspark.sql import functions as F

from orderloom.feeds import cash, couriers, pos, sheets, shopee, tiktok
from orderloom.functions.scalar import EPOCH
from orderloom.plans.registry import cents, query, whole
from orderloom.plans.roles import _text

TODAY = date(2026, 1, 31)


def _cells(df, **cols):
    """Text cells as a landed sheet holds them; a leading word names the file."""
    return df.select(*[c.cast("string").alias(n) if n != "row_no" else c.cast("bigint").alias(n) for n, c in cols.items()])


def _orders(t, **cols):
    return _cells(t.orders, **{"row_no": F.col("o_orderkey"), "source_file": F.col("o_orderpriority"), **cols})


def _events(t, **cols):
    return _cells(t.events, **{"row_no": F.col("event_id"), "source_file": F.col("event_type"), **cols})


def _tagged(df, name):
    return df.withColumns({"courier": F.lit(name), "courieraccount": F.lit("tk1")})


def _day(col, fmt):
    return F.date_format(col, fmt)


@query("""
WITH p AS (SELECT *, CASE o_orderstatus WHEN 'P' THEN 'Don huy' WHEN 'F' THEN 'Da giao hang' ELSE 'Da tra hang' END AS status,
    lpad(cast(o_orderkey AS varchar), 10, '0') AS id FROM orders),
pay AS (SELECT lpad(cast(o_orderkey AS varchar), 10, '0') AS id, o_custkey * 10 AS cod,
    -(-cast(floor(o_totalprice / 100 + 0.5) AS bigint) - o_custkey + 500) AS cost FROM orders WHERE o_orderpriority <> '5-LOW'),
comp AS (SELECT lpad(cast(o_orderkey AS varchar), 10, '0') AS id, o_custkey + 1 AS refund FROM orders
    WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'O')
SELECT p.id AS delivery_orderid, CASE WHEN comp.id IS NOT NULL THEN 'Boi hoan' ELSE status END AS orderstatus,
  pay.cod AS cod_collected, pay.cost AS shippingcost, coalesce(refund, 0) AS compensationvalue, o_orderdate AS createdat,
  CASE WHEN o_orderstatus <> 'P' THEN 'Giao Hang Tiet Kiem' END AS courier
FROM p LEFT JOIN pay ON p.id = pay.id LEFT JOIN comp ON p.id = comp.id
""")
def feed_ghtk_parcels(t):
    key = F.concat(F.lit("S1.A"), F.lpad(F.col("o_orderkey").cast("string"), 10, "0"))
    blank = F.lit(None).cast("string")
    parcels = _orders(t, **{
        "Mã ĐH": key, "Mã ĐH shop": F.col("o_custkey"), "Trạng thái đơn hàng": F.when(
            F.col("o_orderstatus") == "F", "Đã giao hàng").otherwise("Đã trả hàng"), "Giá trị hàng hóa": F.lit(0),
        "Thời gian tạo đơn": _day("o_orderdate", "yyyy-MM-dd HH:mm:ss"), "Thời gian lấy thành công": blank,
        "Thời gian giao hàng thành công": blank, "state": F.col("o_orderstatus"), "kind": F.col("o_orderpriority")})
    fees = {c: blank for c in couriers.GHTK_FEES}
    fees |= {couriers.GHTK_FEES[0]: -whole(F.col("o_totalprice") / 100), couriers.GHTK_FEES[5]: -F.col("o_custkey"),
             couriers.GHTK_FEES[-1]: F.lit(500)}
    pay = _orders(t, STT=F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey").cast("string")).otherwise("Tổng"),
                  **{"Mã đơn hàng": key, "Tiền CoD": F.col("o_custkey") * 10, **fees})
    comp = _cells(t.orders.filter("o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'"),
                  **{"Mã đơn hàng": key, "Tiền bồi hoàn": F.col("o_custkey") + 1})
    sent = _tagged(parcels.filter("state <> 'P'"), "Giao Hang Tiet Kiem")
    out = couriers.clean_ghtk_parcels(sent, pay, parcels.filter("state = 'P'"), comp)
    return out.select("delivery_orderid", "orderstatus", "cod_collected", "shippingcost", "compensationvalue", "createdat",
                      "courier")


@query("""
WITH coin AS (SELECT event_id // 2 AS id, sum(cast(floor(value * 100 + 0.5) AS bigint)) AS coins FROM events
  WHERE event_type <> 'view' GROUP BY 1)
SELECT 'NVS' || o_orderkey AS delivery_orderid, CASE o_orderstatus WHEN 'P' THEN 'Hang that lac' ELSE 'Giao thanh cong' END
    AS orderstatus,
  cast(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_custkey * 100 + CASE WHEN o_orderpriority = '2-HIGH' THEN 7 ELSE 0 END
    + coalesce(coins, 0) END AS bigint) AS cod_collected, o_custkey + 20 AS shippingcost,
  cast(CASE WHEN o_orderstatus = 'P' THEN coalesce(coins, 0) ELSE 0 END AS bigint) AS compensationvalue,
  o_orderdate + CASE WHEN o_orderstatus = 'F' THEN INTERVAL 3 DAY ELSE INTERVAL 1 DAY END AS completedat
FROM orders LEFT JOIN coin ON o_orderkey = coin.id WHERE o_orderpriority <> '5-LOW'
""")
def feed_ghn_parcels(t):
    key = F.concat(F.lit("NVS"), "o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", "_PR").otherwise(""))
    done = F.when(F.col("o_orderstatus") == "F", _day(F.date_add("o_orderdate", 3), "dd/MM/yyyy"))
    parcels = _tagged(_orders(t, **{
        "Mã đơn hàng": key, "Trạng thái": F.when(F.col("o_orderstatus") == "P", couriers.LOST).otherwise("Giao thành công"),
        "Tổng phí dịch vụ": F.col("o_custkey"), "Phí hoàn hàng": F.lit(20), "Tiền COD": F.col("o_custkey") * 100,
        "GTB - Thu tiền": F.lit(7), "Giá trị khai giá": F.lit(0), "Mã đơn hàng riêng": F.col("o_custkey"),
        "Ngày tạo đơn": _day("o_orderdate", "dd/MM/yyyy"), "Ngày lấy hàng thành công": F.lit(None),
        "Ngày giao hàng thành công": done, "Ngày giao hàng lần đầu": _day(F.date_add("o_orderdate", 1), "dd/MM/yyyy"),
        "Ngày thu GTB - thu tiền": F.when(F.col("o_orderpriority") == "2-HIGH", _day("o_orderdate", "dd/MM/yyyy"))}), "GHN")
    coins = _events(t, **{
        "Loại giao dịch": F.when(F.col("event_type") == "view", "Khác").otherwise(couriers.COIN_REFUND),
        "Nội dung": F.concat(F.lit("NVS"), F.floor(F.col("event_id") / 2), F.when(F.col("event_type") == "click", "_PR").otherwise("")),
        "Số tiền": cents("value")})
    return couriers.clean_ghn_parcels(parcels, coins).select(
        "delivery_orderid", "orderstatus", "cod_collected", "shippingcost", "compensationvalue", "completedat")


@query("""
SELECT 'J' || o_orderkey AS delivery_orderid, 'Ky nhan' AS orderstatus,
  coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_custkey END, 0) + 5 AS shippingcost, date_trunc('minute', o_orderdate) AS createdat,
  o_custkey * 2 AS cod_collected FROM orders
""")
def feed_jte_parcels(t):
    blank = F.lit(None)
    rows = _tagged(_orders(t, **{
        "Mã vận đơn": _text("J", "o_orderkey"), "Trạng thái vận đơn": F.lit("Ký nhận"),
        "Thời gian tạo đơn": _day("o_orderdate", "yyyy-MM-dd HH:mm"), "Cước phí": F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")),
        "Tiền thu hộ COD": F.lit(0), "COD thực thu": F.col("o_custkey") * 2, "Mã đơn KH": blank, "Thời gian lấy hàng": blank,
        "Thời gian ký nhận": blank, "Phí lưu kho": F.lit(5)}), "JT Express")
    return couriers.clean_jte_parcels(rows).select("delivery_orderid", "orderstatus", "shippingcost", "createdat", "cod_collected")


@query("""
SELECT 'X' || event_id AS delivery_orderid, CASE WHEN event_type <> 'error' THEN cast(floor(value * 100 + 0.5) AS bigint) END
    AS cod_collected, CASE WHEN event_type <> 'view' THEN date_trunc('minute', ts) END AS completedat,
  CASE WHEN event_type = 'error' THEN false ELSE (cast(floor(value * 100 + 0.5) AS bigint) < 3000
    AND cast(floor(value * 100 + 0.5) AS bigint) <> 0) END AS is_odd
FROM events
""")
def feed_spx_parcels(t):
    rows = _tagged(_events(t, **{
        "Mã vận đơn": _text("X", "event_id"), "Trạng thái hiện tại": F.lit("Đã giao"),
        "Số tiền COD": F.when(F.col("event_type") == "error", "-").otherwise(cents("value").cast("string")),
        "Giá trị đơn hàng": F.lit(5000), "Phí vận chuyển thực tế": F.lit(0), "Thời gian tạo đơn": F.lit("-"),
        "Thời gian lấy hàng/gửi hàng": F.lit("-"), "Thời gian giao hàng": F.when(F.col("event_type") == "view", "-").otherwise(
            _day("ts", "yyyy-MM-dd HH:mm"))}), "SPX Express")
    odd = couriers.spx_outliers(rows).select(F.col("Mã vận đơn").alias("delivery_orderid"), F.lit(True).alias("is_odd"))
    out = couriers.clean_spx_parcels(rows).join(odd, "delivery_orderid", "left")
    return out.select("delivery_orderid", "cod_collected", "completedat", F.coalesce("is_odd", F.lit(False)).alias("is_odd"))


@query("""
SELECT 'TVC_GGSHEET_' || (100000000 + o_orderkey) AS delivery_orderid,
  nullif(CASE WHEN o_orderstatus = 'F' THEN o_custkey * 1000 ELSE 0 END + CASE WHEN o_orderpriority = '2-HIGH' THEN 5 ELSE 0 END, 0)
    AS cod_collected, nullif(o_custkey, 0) AS cod_declared, 0 AS shippingcost, o_orderdate AS createdat
FROM orders WHERE o_orderpriority <> '1-URGENT'
""")
def feed_self_delivery(t):
    key = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderkey")).otherwise(F.col("o_orderkey") + 100_000_000)
    blank = F.lit(None)
    rows = _orders(t, **{c: blank for c in couriers.SELF_DELIVERY} | {
        "STT": F.lit("1"), "Ngày lên": _day("o_orderdate", "dd/MM/yyyy"), "ID đơn": F.concat(F.lit(" "), key, F.lit("\n")),
        "Trạng thái": F.lit("Đã giao"), "Tổng Cod": F.col("o_custkey"), "Phí Ship": F.lit(""),
        "Cod BANK": F.when(F.col("o_orderstatus") == "F", F.concat("o_custkey", F.lit(".000đ"))).otherwise(""),
        "Cod Tiền mặt": F.when(F.col("o_orderpriority") == "2-HIGH", "5").otherwise("")})
    return couriers.clean_self_delivery(rows).select(
        "delivery_orderid", "cod_collected", "cod_declared", "shippingcost", "createdat")


@query("""
SELECT 'a-' || strftime(ts, '%Y%m%d') || '-' || strftime(ts, '%m%d') AS sessionid, 'J' || user_id AS delivery_orderid,
  cast(sum(floor(value * 100 + 0.5)) AS bigint) AS reconciliation_value,
  CASE WHEN event_type = 'error' THEN TIMESTAMP '2026-01-31' ELSE min(date_trunc('day', ts)) + INTERVAL 1 DAY END
    AS reconciliation_at
FROM events GROUP BY event_type, 1, 2, date_trunc('day', ts)
UNION ALL SELECT 'khong ma', 'J0', 1, TIMESTAMP '2026-01-31' FROM region WHERE r_regionkey = 0
""")
def feed_jte_cash(t):
    rows = _events(t, **{
        "Mã vận đơn": _text("J", "user_id"), "Tiền thực nhận": cents("value"),
        "Kỳ thanh toán": F.concat(F.lit("a-"), _day("ts", "yyyyMMdd"), F.lit("-"), _day("ts", "MMdd"))})
    torn = _cells(t.region.filter("r_regionkey = 0"), **{
        "row_no": F.lit(-1), "source_file": F.lit("error"), "Mã vận đơn": F.lit("J0"), "Tiền thực nhận": F.lit(1),
        "Kỳ thanh toán": F.lit("khong ma")})
    return cash.clean_jte_cash(rows.unionByName(torn), TODAY).select(
        "sessionid", "delivery_orderid", "reconciliation_value", "reconciliation_at")


@query("""
SELECT 't' || event_id AS sessionid, 'X' || user_id AS delivery_orderid, cast(floor(value * 100 + 0.5) AS bigint)
  AS reconciliation_value, date_trunc('second', ts) AS reconciliation_at FROM events WHERE event_type NOT IN ('error', 'click')
""")
def feed_spx_cash(t):
    rows = _events(t, **{
        "Mã giao dịch": F.when(F.col("event_type") == "click", _text("c", "user_id")).otherwise(_text("t", "event_id")),
        "Mã vận đơn": _text("X", "user_id"), "Thời gian giao dịch": _day("ts", "yyyy/MM/dd HH:mm:ss"),
        "Số tiền (VND)": F.when(F.col("event_type") == "error", F.col("value").cast("string")).otherwise(
            cents("value").cast("string"))})
    return cash.clean_spx_cash(rows).select("sessionid", "delivery_orderid", "reconciliation_value", "reconciliation_at")


@query("""
SELECT 'COD_' || event_type AS sessionid, 'NVS' || user_id AS delivery_orderid,
  cast(sum(floor(value * 100 + 0.5)) AS bigint) AS reconciliation_value,
  CASE event_type WHEN 'view' THEN TIMESTAMP '2026-01-31' ELSE TIMESTAMP '2024-02-05' END AS reconciliation_at
FROM events WHERE event_type <> 'error' AND user_id <> 3 GROUP BY event_type, user_id
""")
def feed_ghn_cash(t):
    kind = F.col("event_type")
    rows = _events(t, **{
        "Mã đơn GHN": F.when(F.col("user_id") != 3, _text("NVS", "user_id")), cash.GHN_CASH[1]: cents("value"),
        "session_id": F.concat(F.when(kind == "error", "XXX_").otherwise("COD_"), kind),
        "session_date": F.when(kind == "view", "hom nay").otherwise("05/02/2024")})
    return cash.clean_ghn_cash(rows, TODAY).select("sessionid", "delivery_orderid", "reconciliation_value", "reconciliation_at")


@query("""
SELECT strftime(ts, '%Y-%m-%d %H:%M') || '_denbu' || event_type AS sessionid, 'NVS' || user_id AS delivery_orderid,
  cast(sum(floor(value * 100 + 0.5)) AS bigint) AS reconciliation_value, date_trunc('minute', ts) AS reconciliation_at
FROM events GROUP BY event_type, 1, 2, 4
""")
def feed_ghn_coin_moves(t):
    rows = _events(t, **{
        "Ngày": _day("ts", "dd/MM/yyyy HH:mm"), "Loại giao dịch": F.concat(F.lit("Đền bù "), "event_type"),
        "Nội dung": F.concat(F.lit("NVS"), "user_id", F.when(F.col("value") > 20, "_PR").otherwise("")), "Số tiền": cents("value")})
    return cash.clean_ghn_coin_moves(rows, TODAY).select(
        "sessionid", "delivery_orderid", "reconciliation_value", "reconciliation_at")


@query("""
WITH sheet AS (SELECT 'KB_' || event_id AS id, user_id, event_id, CASE WHEN event_type IN ('purchase', 'signup')
    THEN cast(floor(value + 0.5) AS bigint) * 1000 END AS cell, event_type, ts FROM events WHERE event_type <> 'error'),
filled AS (SELECT *, last_value(cell IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS amount FROM sheet),
marked AS (SELECT *, CASE WHEN amount = lag(amount) OVER (PARTITION BY user_id ORDER BY event_id) THEN 0 ELSE 1 END AS start
    FROM filled),
numbered AS (SELECT *, sum(start) OVER (PARTITION BY user_id ORDER BY event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM marked)
SELECT id AS bank_surrogateid, user_id || ',' || event_id AS orderid,
  cast(amount AS double) / cast(count(*) OVER (PARTITION BY user_id, run) AS double) AS bankvalue,
  CASE WHEN event_type = 'view' THEN NULL ELSE '09' || user_id END AS customerphonenumber, cast(ts AS date) AS notedate
FROM numbered
""")
def feed_customer_bank(t):
    kind = F.col("event_type")
    rows = _events(t, source_file=_text("sheet ", "user_id"), **{
        "ID": F.concat(F.when(kind == "error", "loi ").otherwise("KB_"), "event_id"), "Ngày": _day("ts", "dd/MM/yyyy"),
        "ID đơn hàng": F.concat(F.lit(" "), "user_id", F.lit(" +\n"), "event_id"),
        "Sđt khách bank": F.when(kind == "view", "").otherwise(_text("9", "user_id")),
        "Số tiền bank": F.when(kind.isin("purchase", "signup"), F.concat(whole("value"), F.lit(".000 đ"))).otherwise(""),
        "Người xác nhận": F.lit(""), "Mã FT": F.lit(""), "Ghi chú": F.lit("")})
    return sheets.clean_customer_bank(rows, block_rows=4096).select(
        "bank_surrogateid", "orderid", "bankvalue", "customerphonenumber", "notedate")


@query("""
WITH sheet AS (SELECT event_id, user_id, CASE WHEN event_type <> 'click' THEN 'NVS' || lpad(cast(event_id AS varchar), 9, '0') END
    AS parcel, CASE WHEN event_type = 'view' THEN day(ts) END AS d FROM events),
filled AS (SELECT *, last_value(parcel IGNORE NULLS) OVER w AS p, last_value(d IGNORE NULLS) OVER w AS dd FROM sheet
  WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT 'k' || event_id AS scan_surrogateid, p AS delivery_orderid, 'MDU' || user_id AS productid,
  CASE WHEN dd IS NOT NULL THEN make_date(2026, 1, dd) END AS scanat FROM filled
""")
def feed_return_scans(t):
    kind = F.col("event_type")
    rows = _events(t, source_file=_text("sheet ", "user_id"), **{
        "Key": _text("k", "event_id"), "NGÀY": F.when(kind == "view", _day("ts", "d")).otherwise(""), "THÁNG": F.lit("T1"),
        "Mã vận đơn": F.when(kind != "click", F.concat(F.lit("nvs"), F.lpad(F.col("event_id").cast("string"), 9, "0"),
                                                     F.lit("_pr"))).otherwise(""),
        "Col1": F.lit(""), "Mã SP": F.concat(F.lit("mdu "), "user_id")})
    return sheets.clean_return_scans(rows, 2026, block_rows=4096).select(
        "scan_surrogateid", "delivery_orderid", "productid", "scanat")


@query("""
SELECT 'AB' || event_id AS delivery_orderid, cast(ts AS date) AS scan_deliveryorder_at, CAST(NULL AS VARCHAR) AS note
FROM events WHERE event_type <> 'error'
UNION ALL SELECT 'P' || user_id, NULL, CASE WHEN event_type <> 'view' THEN event_type END FROM events
""")
def feed_scans_and_notes(t):
    scans = _events(t, **{"Mã vận đơn": F.when(F.col("event_type") == "error", " ").otherwise(F.concat(F.lit("a b"), "event_id")),
                          "Ngày bắn đơn": _day("ts", "yyyy-MM-dd")})
    notes = _events(t, **{"Mã vận đơn": _text("P", "user_id"), "Ghi chú 1": F.when(
        F.col("event_type") == "view", "").otherwise(F.col("event_type")), "Ghi chú 2": F.lit(""), "Ghi chú 3": F.lit("")})
    both = sheets.clean_delivery_scans(scans).unionByName(sheets.clean_handling_notes(notes))
    return both.select("delivery_orderid", "scan_deliveryorder_at", F.col("handleteam_note1").alias("note"))


@query("""
SELECT 'MDU' || (1000 + p_partkey % 9000) AS productid, CASE WHEN p_type <> 'PROMO' THEN p_size * 1000 END AS retailprice,
  p_type AS cate_purpose FROM part WHERE (SELECT count(*) FROM part WHERE p_type <> 'PROMO') >= 100
""")
def feed_catalogue(t):
    size = F.when(F.col("p_type") == "PROMO", "hỏi giá").otherwise(F.concat(F.lit("Giá "), "p_size", F.lit("K")))
    blank = F.lit("")
    rows = _cells(t.part, **{"row_no": F.col("p_partkey"), **{c: blank for c in sheets.CATALOGUE}} | {
        "Mã SP": F.concat(F.lit(" mdu"), F.col("p_partkey") % 9000 + 1000), "Giá nội bộ": size, "Mục đích": F.col("p_type")})
    return sheets.clean_catalogue(rows, 100).select("productid", "retailprice", "cate_purpose")


@query(r"""
SELECT cast(o_orderkey AS varchar) AS orderid, o_orderdate AS created_at, lower(c_name) AS customername,
  CASE o_orderstatus WHEN 'F' THEN 'thanh cong' WHEN 'O' THEN 'khach huy' END AS orderstatus,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'don doi' WHEN '2-HIGH' THEN 'bo sung' ELSE 'di moi' END AS orderparentsource,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'fb-quang cao' WHEN '2-HIGH' THEN 'zalo' ELSE 'truc tiep' END AS ordersource,
  CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE 0 END + 5 AS cod_prepaid,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS senddelivery_at,
  CASE WHEN o_orderpriority = '1-URGENT' THEN cast(100000000 + o_orderkey AS varchar) END AS previousid_internalnote,
  o_orderpriority = '2-HIGH' AS is_wrongproduct
FROM orders JOIN customer ON o_custkey = c_custkey
""")
def feed_pos_orders(t):
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    kind, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    created = F.timestamp_diff("SECOND", F.expr(EPOCH), F.col("o_orderdate")) - 7 * 3600
    origin = F.when(kind == "1-URGENT", "FB-Quảng cáo - Đơn đổi").when(kind == "2-HIGH", "Zalo - Bổ sung").otherwise("Trực tiếp")
    note = F.when(kind == "1-URGENT", F.concat(F.lit("đổi "), F.col("o_orderkey") + 100_000_000)).when(
        kind == "2-HIGH", "di = abc")
    text = F.lit(None).cast("string")
    amount = F.when(status == "F", F.col("o_custkey"))
    docs = rows.select(
        F.struct(F.col("o_orderkey").cast("string").alias("id"), created.alias("createdAt"), status.alias("status"),
                 note.alias("privateDescription"), text.alias("description"), text.alias("createdByName")).alias("info"),
        F.struct(F.col("c_name").alias("name"), text.alias("mobile"), text.alias("cityId"), text.alias("districtId")).alias(
            "shippingAddress"),
        F.struct(text.alias("name"), text.alias("carrierCode"), F.when(status == "P", 0).otherwise(created).alias(
            "sendCarrierAt")).alias("carrier"),
        F.struct(origin.alias("trafficSource"), text.alias("saleChannel")).alias("channel"),
        F.struct(F.struct(F.lit(5).cast("bigint").alias("amount")).alias("transfer"),
                 F.when(amount.isNotNull(), F.struct(amount.alias("amount"))).alias("deposit")).alias("payment"))
    codes = t.spark.createDataFrame([("F", "thanh cong"), ("O", "khach huy")], "code string, label string")
    return pos.clean_pos_orders(docs, {"orderstatus": codes}).select(
        "orderid", "created_at", "customername", "orderstatus", "orderparentsource", "ordersource", "cod_prepaid",
        "senddelivery_at", "previousid_internalnote", "is_wrongproduct")


@query("""
WITH line AS (SELECT l_orderkey AS id, upper('p' || l_partkey || '-' || l_returnflag) AS sku, l_linenumber AS qty FROM lineitem
  UNION ALL SELECT l_orderkey, '', l_suppkey FROM lineitem)
SELECT cast(id AS varchar) AS orderid, sku AS productid, split_part(sku, '-', 1) AS parentproductid, qty AS quantity FROM line
""")
def feed_pos_lines(t):
    def product(code, qty):
        return F.struct(code.alias("code"), F.lit("b").alias("barcode"), F.lit(1).cast("bigint").alias("price"),
                        F.lit(0).cast("bigint").alias("discountAmount"), qty.cast("bigint").alias("quantity"))

    sku = F.concat(F.lit("p"), "l_partkey", F.lit("-"), "l_returnflag")
    docs = t.lineitem.select(
        F.struct(F.col("l_orderkey").cast("string").alias("id")).alias("info"),
        F.array(product(sku, F.col("l_linenumber")), product(F.lit(None).cast("string"), F.col("l_suppkey"))).alias("products"))
    return pos.clean_pos_lines(docs).select("orderid", "productid", "parentproductid", "quantity")


@query("""
SELECT 'S' || o_orderkey AS orderid, CASE WHEN o_orderpriority <> '1-URGENT' THEN 'Hoa toc' END AS courier,
  CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS completedat, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END
    AS pickupat, CASE o_orderpriority WHEN '2-HIGH' THEN 'r1,r2' END AS returned_orderids,
  CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS collectedvalue_theory,
  CASE WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN 'T' || o_orderkey END AS delivery_orderid
FROM orders
""")
def feed_shopee_orders(t):
    kind, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    at = F.timestamp_diff("SECOND", F.expr(EPOCH), F.col("o_orderdate")) - 7 * 3600
    package = F.struct(_text("P", "o_orderkey").alias("package_number"), F.lit("Hỏa tốc").alias("shipping_carrier"))
    sn, text = _text("S", "o_orderkey").alias("order_sn"), F.lit(None).cast("string")
    none = F.array().cast("array<struct<package_number: string, shipping_carrier: string>>")
    orders = t.orders.select(
        sn, F.when(kind == "1-URGENT", none).otherwise(F.array(package)).alias("package_list"), at.alias("create_time"),
        F.when(status == "P", 0).otherwise(at).alias("pickup_done_time"), at.alias("update_time"),
        F.when(status == "F", "COMPLETED").otherwise("SHIPPED").alias("order_status"), text.alias("cancel_reason"),
        text.alias("buyer_username"))
    number = F.lit(None).cast("bigint")
    escrows = t.orders.filter("o_orderpriority <> '5-LOW'").select(
        sn, F.when(kind == "2-HIGH", F.array(F.lit("r1"), F.lit("r2"))).otherwise(F.array().cast("array<string>")).alias(
            "return_order_sn_list"), F.struct(number.alias("buyer_total_amount")).alias("buyer_payment_info"),
        F.struct(text.alias("buyer_payment_method"), F.col("o_custkey").alias("escrow_amount"),
                 *[number.alias(c) for c in ("actual_shipping_fee", "shopee_shipping_rebate", "seller_shipping_discount")]
                 ).alias("order_income"))
    trackings = t.orders.select(
        _text("P", "o_orderkey").alias("package_number"),
        F.when(kind.isin("2-HIGH", "3-MEDIUM"), _text("T", "o_orderkey")).otherwise("").alias("tracking_number"))
    return shopee.clean_shopee_orders(orders, escrows, trackings, "shop").select(
        "orderid", "courier", "completedat", "pickupat", "returned_orderids", "collectedvalue_theory", "delivery_orderid")


@query("""
WITH line AS (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem)
SELECT 'S' || l_orderkey AS orderid, 'M' || l_partkey || '_' || l_suppkey || '_' || l_linenumber AS orderproduct_id,
  CASE WHEN l_partkey % 2 = 0 THEN 1000 - cast(l_suppkey * 10 AS double) / l_linenumber ELSE 900.0 END AS realprice,
  l_suppkey AS shopdiscount_allquantities
FROM line
""")
def feed_shopee_lines(t):
    line = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").distinct()
    sn, qty, text = _text("S", "l_orderkey").alias("order_sn"), F.col("l_linenumber").cast("bigint"), F.lit("x")
    item = F.struct(
        text.alias("item_sku"), _text("K", "l_partkey").alias("model_sku"), _text("M", "l_partkey").alias("model_id"),
        F.col("l_suppkey").cast("string").alias("item_id"), text.alias("item_name"), text.alias("model_name"),
        qty.alias("model_quantity_purchased"), F.lit(1000).cast("bigint").alias("model_original_price"),
        F.when(F.col("l_partkey") % 2 == 0, F.lit(0.0)).otherwise(F.lit(900.0)).alias("model_discounted_price"))
    off = F.struct(
        _text("K", "l_partkey").alias("model_sku"), _text("M", "l_partkey").alias("model_id"),
        F.col("l_suppkey").cast("string").alias("item_id"), qty.alias("quantity_purchased"),
        (F.col("l_suppkey") * 10).alias("seller_discount"), F.col("l_suppkey").alias("discount_from_voucher_seller"),
        F.lit(0).cast("bigint").alias("discount_from_voucher_shopee"))
    orders = line.select(sn, F.array(item).alias("item_list"))
    escrows = line.select(sn, F.struct(F.array(off).alias("items")).alias("order_income"))
    return shopee.clean_shopee_lines(orders, escrows).select(
        "orderid", "orderproduct_id", "realprice", "shopdiscount_allquantities")


@query("""
SELECT 'S' || event_id || '_' || cast(floor(value * 100 + 0.5) AS bigint) || '_' || (epoch_us(ts) // 1000000 - 25200) AS sessionid,
  'S' || event_id AS delivery_orderid, date_trunc('second', ts) AS reconciliation_at FROM events
""")
def feed_shopee_income(t):
    at = F.timestamp_diff("SECOND", F.expr(EPOCH), F.col("ts")) - 7 * 3600
    rows = t.events.select(_text("S", "event_id").alias("order_sn"), cents("value").alias("released_amount"),
                           at.alias("actual_payout_time"))
    return shopee.clean_shopee_income(rows).select("sessionid", "delivery_orderid", "reconciliation_at")


@query("""
WITH back AS (SELECT l_orderkey, l_shipdate, 'ly do ' || l_linenumber AS reason, l_suppkey + l_partkey AS fee,
    lpad(l_partkey || '-' || l_suppkey, 60, '0') AS track FROM lineitem WHERE l_returnflag = 'R'
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, substr(track, 1, 49) DESC) = 1)
SELECT 'K' || o_orderkey AS orderid, o_orderdate AS create_time, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END
    AS actual_shipping_fee, 'Ha Noi' AS buyeraddress_lv1, CAST(NULL AS VARCHAR) AS buyeraddress_lv2,
  substr(track, 1, 49) AS returned_trackingnumber, back.l_shipdate IS NOT NULL AS is_back
FROM orders LEFT JOIN back ON o_orderkey = l_orderkey
""")
def feed_tiktok_orders(t):
    text, number = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    at = F.timestamp_diff("SECOND", F.expr(EPOCH), F.col("o_orderdate")) - 7 * 3600
    place = F.array(F.struct(F.lit("Việt Nam").alias("address_name")), F.struct(F.lit("Hà Nội").alias("address_name")))
    fee = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_custkey").cast("string"))
    orders = t.orders.select(
        _text("K", "o_orderkey").alias("id"), at.alias("create_time"),
        *[number.alias(c) for c in ("collection_time", "delivery_time", "cancel_time")],
        *[text.alias(c) for c in ("shipping_provider", "status", "cancel_reason", "buyer_email", "payment_method_name",
                                  "tracking_number")],
        F.struct(fee.alias("shipping_fee"), *[text.alias(c) for c in (
            "original_shipping_fee", "shipping_fee_platform_discount", "shipping_fee_seller_discount")]).alias("payment"),
        F.struct(place.alias("district_info")).alias("recipient_address"))
    paid = F.array(F.struct(*[F.col(c).cast("string").alias(f"{who}_paid_return_shipping_fee") for who, c in (
        ("buyer", "l_suppkey"), ("platform", "l_partkey"), ("seller", "l_linenumber"))]))
    returns = t.lineitem.filter("l_returnflag = 'R'").select(
        _text("K", "l_orderkey").alias("order_id"), F.timestamp_diff("SECOND", F.expr(EPOCH), F.col("l_shipdate")).alias(
            "create_time"), _text("ly do ", "l_linenumber").alias("return_reason_text"),
        F.lpad(F.concat("l_partkey", F.lit("-"), "l_suppkey"), 60, "0").alias("return_tracking_number"),
        text.alias("return_status"), paid.alias("shipping_fee_amount"))
    out = tiktok.clean_tiktok_orders(orders, returns, "shop")
    return out.select("orderid", "create_time", "actual_shipping_fee", "buyeraddress_lv1", "buyeraddress_lv2",
                      "returned_trackingnumber", F.col("returnshippingfee_paidbybuyer").isNotNull().alias("is_back"))


@query("""
WITH item AS (SELECT 'K' || l_orderkey AS orderid, 'S' || l_suppkey AS product_skuid, 'P' || l_partkey AS productid,
    l_linenumber * 100 AS displayprice, cast(floor(l_discount * 100 + 0.5) AS bigint) AS off FROM lineitem
  WHERE l_returnflag <> 'R' UNION ALL
  SELECT 'K' || l_orderkey, 'S' || l_suppkey, 'P' || l_partkey, l_linenumber * 100, 7 FROM lineitem WHERE l_returnflag <> 'R'),
grouped AS (SELECT orderid, product_skuid, productid, displayprice, count(*) AS quantity, cast(sum(off) AS bigint) AS off
  FROM item GROUP BY ALL)
SELECT orderid, product_skuid, productid, displayprice, quantity, off AS shopdiscount_allquantities FROM grouped
QUALIFY row_number() OVER (PARTITION BY orderid, product_skuid ORDER BY productid, displayprice) = 1
""")
def feed_tiktok_lines(t):
    sku = F.when(F.col("l_returnflag") != "R", _text("S", "l_suppkey"))

    def item(off):
        return F.struct(sku.alias("seller_sku"), _text("P", "l_partkey").alias("product_id"), F.lit("n").alias("product_name"),
                        F.lit("s").alias("sku_name"), (F.col("l_linenumber") * 100).cast("string").alias("original_price"),
                        off.cast("string").alias("seller_discount"), F.lit("").alias("platform_discount"))

    orders = t.lineitem.select(_text("K", "l_orderkey").alias("id"),
                               F.array(item(cents("l_discount")), item(F.lit(7))).alias("line_items"))
    return tiktok.clean_tiktok_lines(orders).select(
        "orderid", "product_skuid", "productid", "displayprice", "quantity", "shopdiscount_allquantities")


@query("""
SELECT 'K' || event_id AS order_or_statement_id, cast(ts AS date) AS transactiontime, 'Don hang' AS transactiontype,
  cast(floor(value * 100 + 0.5) AS bigint) AS revenue, -user_id AS totalfee FROM events WHERE event_type <> 'error'
""")
def feed_tiktok_income(t):
    names = tiktok.INCOME
    amount = F.when((F.col("event_type") == "error") & (F.col("user_id") == 3), "1.5").otherwise(cents("value").cast("string"))
    rows = _events(t, **{c: F.lit("0") for c in names.values()} | {
        names["order_or_statement_id"]: _text("K", "event_id"), names["transactiontime"]: _day("ts", "yyyy/MM/dd"),
        names["transactiontype"]: F.lit("Đơn hàng"), names["revenue"]: amount, names["totalfee"]: -F.col("user_id")})
    return tiktok.clean_tiktok_income(rows).select(
        "order_or_statement_id", "transactiontime", "transactiontype", "revenue", "totalfee")
