"""Every cleaner on a small landed feed with the odd cases of its source."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

import landing
from orderloom.feeds import cash, couriers, pos, sheets, shopee, tiktok
from orderloom.sources.landed import (
    assign_chunk, read_grid, read_landed_json, read_landed_table, table_from_grid, time_chunks, with_header_cells,
)

TODAY = date(2026, 1, 31)


def frame(spark, columns, lines, **tags):
    data = [(i, *[line.get(c) for c in columns], tags.get("file", "f1")) for i, line in enumerate(lines, 1)]
    schema = ", ".join(["row_no bigint", *[f"`{c}` string" for c in columns], "source_file string"])
    df = spark.createDataFrame(data, schema)
    for name in ("courier", "courieraccount"):
        if name in tags:
            df = df.withColumn(name, F.lit(tags[name]))
    return df


def by(df, key):
    return {r[key]: r for r in df.collect()}


# ---- landed files

def test_landed_table_guards_and_order(spark, tmp_path):
    cols = ["Mã SP", "note"]
    landing.sheet(tmp_path / "GHN đối soát" / "a.csv", cols, [{"Mã SP": "x\ny", "note": "1"}, {"Mã SP": "z"}])
    landing.sheet(tmp_path / "GHN đối soát" / "a (1).csv", cols, [{"Mã SP": "again"}])
    folder = str(tmp_path / "GHN đối soát")
    df = read_landed_table(spark, folder, cols, path_tokens=("ghn", "đối soát"), source="GHN", account="tk1", multiline=True)
    got = [tuple(r) for r in df.drop("source_file").orderBy("row_no").collect()]
    assert got == [(1, "x\ny", "1", "GHN", "tk1"), (2, "z", None, "GHN", "tk1")]
    with pytest.raises(Exception, match="path must contain"):
        read_landed_table(spark, folder, cols, path_tokens=("spx",)).count()
    assert read_landed_table(spark, folder, cols, path_tokens=("spx",), bad_path="skip").count() == 0


def test_landed_table_refuses_a_cut_cell(spark, tmp_path):
    whole, inner, last = (str(tmp_path / n) for n in ("whole", "inner", "last"))
    for folder, lines in ((whole, '1,"a ""b"", c",5\n2,5" pipe,6\n3,,\n4,,"x"\n'), (inner, '1,x,5\n2,"o1\no2",6\n'), (last, '1,x,"o1\no2"\n')):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "a.csv").write_text(f"row_no,ids,amount\n{lines}")
    got = [tuple(r) for r in read_landed_table(spark, whole, ["ids", "amount"]).drop("source_file").orderBy("row_no").collect()]
    assert got == [(1, 'a "b", c', "5"), (2, '5" pipe', "6"), (3, None, None), (4, None, "x")]
    for folder in (inner, last):
        with pytest.raises(Exception, match="read with multiline"):
            read_landed_table(spark, folder, ["ids", "amount"]).select("amount").collect()
    assert read_landed_table(spark, inner, ["ids", "amount"], multiline=True).select("ids", "amount").collect()[1] == ("o1\no2", "6")


def test_grid_header_cells_and_column_choice(spark, tmp_path):
    cells = {(8, 1): "COD_1", (9, 1): "05/02/2024"}
    landing.grid(tmp_path / "one.csv", ["b", "a", "c"], [{"a": "1", "b": "2"}], 20, cells)
    landing.grid(tmp_path / "two.csv", ["a", "b"], [{"a": "3", "b": "4"}], 20, {(8, 1): "COD_2"})
    grid = read_grid(spark, str(tmp_path))
    rows = with_header_cells(table_from_grid(grid, ["a", "b"], skip_rows=20), grid, cash.GHN_CASH_CELLS)
    got = sorted(tuple(r) for r in rows.select("a", "b", "session_id", "session_date").collect())
    assert got == [("1", "2", "COD_1", "05/02/2024"), ("3", "4", "COD_2", "x")]
    with pytest.raises(Exception, match="no column"):
        table_from_grid(grid, ["zzz"], skip_rows=20).collect()


def test_chunks(spark):
    chunks = time_chunks(spark, "2024-01-01 00:00:00", "2024-01-30 23:59:59", 13).orderBy("chunk").collect()
    assert [(c.starts.day, c.ends) for c in chunks] == [
        (1, datetime(2024, 1, 13, 23, 59, 59)), (14, datetime(2024, 1, 26, 23, 59, 59)), (27, datetime(2024, 1, 30, 23, 59, 59))]
    df = spark.createDataFrame([(datetime(2024, 1, 13, 23, 59, 59),), (datetime(2024, 1, 14),)], "t timestamp_ntz")
    assert [r.chunk for r in assign_chunk(df, "t", "2024-01-01 00:00:00", 13).orderBy("t").collect()] == [0, 1]


# ---- couriers

GHTK = {"Mã ĐH": "S1.A2.0123456789", "Mã ĐH shop": "N1", "Trạng thái đơn hàng": "Đã giao hàng", "Giá trị hàng hóa": "100000",
        "Thời gian tạo đơn": "2024-01-02 03:04:05"}


def test_ghtk(spark):
    parcels = frame(spark, couriers.GHTK_PARCELS, [GHTK, {**GHTK, "Mã ĐH": "2222222222"}], courier="Giao Hang Tiet Kiem", courieraccount="tk1")
    cancelled = frame(spark, couriers.GHTK_PARCELS, [{**GHTK, "Mã ĐH": "3333333333"}])
    pay = frame(spark, couriers.GHTK_PAYMENTS, [
        {"STT": "1", "Mã đơn hàng": "x0123456789".replace("x", "1."), "Tiền CoD": "5000", "Phí giao hàng": "-20000", "Khuyến mãi": "1000"},
        {"STT": "Tổng", "Mã đơn hàng": "total"}])
    comp = frame(spark, couriers.GHTK_COMPENSATIONS, [{"Mã đơn hàng": "2222222222", "Tiền bồi hoàn": "70000"}])
    got = by(couriers.clean_ghtk_parcels(parcels, pay, cancelled, comp), "delivery_orderid")
    one, two, three = got["0123456789"], got["2222222222"], got["3333333333"]
    assert (one.orderstatus, one.cod_collected, one.shippingcost, one.compensationvalue) == ("Da giao hang", 5000, 19000, 0)
    assert one.createdat == datetime(2024, 1, 2, 3, 4, 5) and one.completedat is None and one.courieraccount == "tk1"
    assert (two.orderstatus, two.compensationvalue, two.shippingcost) == ("Boi hoan", 70000, None)
    assert (three.orderstatus, three.courier, three.courieraccount) == ("Don huy", None, None)
    for bad, text in [(frame(spark, couriers.GHTK_COMPENSATIONS, [{"Mã đơn hàng": "2222222222", "Tiền bồi hoàn": "0"}]), "not above 0"),
                      (frame(spark, couriers.GHTK_COMPENSATIONS, [{"Mã đơn hàng": "22222222ab", "Tiền bồi hoàn": "1"}]), "not 10 digits")]:
        with pytest.raises(Exception, match=text):
            couriers.clean_ghtk_parcels(parcels, pay, None, bad).collect()


GHN = {"Trạng thái": "Giao thành công", "Tổng phí dịch vụ": "20000", "Phí hoàn hàng": "5000", "Tiền COD": "300000",
       "GTB - Thu tiền": "10000", "Giá trị khai giá": "300000", "Ngày tạo đơn": "02/01/2024", "Ngày giao hàng lần đầu": "05/01/2024"}


def test_ghn(spark):
    parcels = frame(spark, couriers.GHN_PARCELS, [
        {**GHN, "Mã đơn hàng": "NVS1"}, {**GHN, "Mã đơn hàng": "NVS1_PR"},
        {**GHN, "Mã đơn hàng": "NVS2", "Ngày thu GTB - thu tiền": "06/01/2024", "Ngày giao hàng thành công": "04/01/2024"},
        {**GHN, "Mã đơn hàng": "NVS3", "Trạng thái": "Hàng thất lạc"}], courier="Giao Hang Nhanh", courieraccount="tk1")
    coins = frame(spark, couriers.GHN_COINS, [
        {"Loại giao dịch": couriers.COIN_REFUND, "Nội dung": "NVS1_PR", "Số tiền": "1000"},
        {"Loại giao dịch": couriers.COIN_REFUND, "Nội dung": "NVS1", "Số tiền": "500"},
        {"Loại giao dịch": couriers.COIN_REFUND, "Nội dung": "NVS3", "Số tiền": "90000"},
        {"Loại giao dịch": "Khác", "Nội dung": "NVS2", "Số tiền": "7"}])
    got = by(couriers.clean_ghn_parcels(parcels, coins), "delivery_orderid")
    assert set(got) == {"NVS1", "NVS2", "NVS3"}
    assert (got["NVS1"].cod_collected, got["NVS1"].shippingcost, got["NVS1"].compensationvalue) == (301500, 25000, 0)
    assert got["NVS1"].completedat == datetime(2024, 1, 5) and got["NVS2"].completedat == datetime(2024, 1, 4)
    assert got["NVS2"].cod_collected == 310000
    assert (got["NVS3"].cod_collected, got["NVS3"].compensationvalue, got["NVS3"].orderstatus) == (0, 90000, "Hang that lac")
    with pytest.raises(Exception, match="Tiền COD is missing"):
        couriers.clean_ghn_parcels(frame(spark, couriers.GHN_PARCELS, [{**GHN, "Mã đơn hàng": "a", "Tiền COD": None}], courier="g", courieraccount="t"), coins).collect()


def test_jte_and_spx(spark):
    jte = frame(spark, couriers.JTE_PARCELS, [{"Mã vận đơn": "J1", "Trạng thái vận đơn": "Ký nhận", "Cước phí": "20000",
        "COD thực thu": "1000", "Tiền thu hộ COD": "2000", "Thời gian tạo đơn": "2024-01-02 03:04"}], courier="JT Express", courieraccount="tk2")
    row = couriers.clean_jte_parcels(jte).first()
    assert (row.shippingcost, row.orderstatus, row.cod_collected, row.createdat) == (20000, "Ky nhan", 1000, datetime(2024, 1, 2, 3, 4))
    spx = frame(spark, couriers.SPX_PARCELS, [
        {"Mã vận đơn": "X1", "Số tiền COD": "-", "Giá trị đơn hàng": "2999", "Phí vận chuyển thực tế": "0", "Thời gian tạo đơn": "2024-01-02 03:04", "Thời gian giao hàng": "-"},
        {"Mã vận đơn": "X2", "Số tiền COD": "3000", "Giá trị đơn hàng": "1000000001", "Phí vận chuyển thực tế": "15000"},
        {"Mã vận đơn": "X3", "Số tiền COD": "3000", "Giá trị đơn hàng": "3000", "Phí vận chuyển thực tế": "15000"}], courier="SPX Express", courieraccount="t")
    got = by(couriers.clean_spx_parcels(spx), "delivery_orderid")
    assert (got["X1"].cod_collected, got["X1"].completedat, got["X1"].shop_orderid) == (None, None, None)
    assert sorted(r["Mã vận đơn"] for r in couriers.spx_outliers(spx).collect()) == ["X1", "X2"]


def test_self_delivery(spark):
    base = {"STT": "1", "Trạng thái": "Đã giao", "Ngày lên": "02/01/2024"}
    df = frame(spark, couriers.SELF_DELIVERY, [
        {**base, "ID đơn": " 123456789 ", "Cod BANK": "1.000đ", "Cod Tiền mặt": "", "Tổng Cod": "", "Phí Ship": "20.000"},
        {**base, "ID đơn": "12345678", "Cod BANK": "1", "Cod Tiền mặt": "1", "Tổng Cod": "1", "Phí Ship": "1"},
        {**base, "ID đơn": ""}, {**base, "STT": "STT", "ID đơn": "ID đơn"},
        {**base, "ID đơn": "987654321", "Cod BANK": "", "Cod Tiền mặt": "", "Tổng Cod": "5", "Phí Ship": ""}])
    got = by(couriers.clean_self_delivery(df), "delivery_orderid")
    assert set(got) == {"TVC_GGSHEET_123456789", "TVC_GGSHEET_987654321"}
    one, two = got["TVC_GGSHEET_123456789"], got["TVC_GGSHEET_987654321"]
    assert (one.cod_collected, one.cod_declared, one.shippingcost, one.courier) == (1000, None, 20000, "Tu Van Chuyen")
    assert (two.cod_collected, two.cod_declared, two.shippingcost) == (None, 5, 0)


# ---- cash

def test_jte_cash(spark):
    rows = [{"Mã vận đơn": "J1", "Tiền thực nhận": "100", "Kỳ thanh toán": "acct-20240131-0131"},
            {"Mã vận đơn": "J1", "Tiền thực nhận": "50", "Kỳ thanh toán": "acct-20240131-0131"},
            {"Mã vận đơn": "Tổng cộng", "Tiền thực nhận": "150"}]
    good = frame(spark, cash.JTE_CASH, rows)
    bad = frame(spark, cash.JTE_CASH, [{"Mã vận đơn": "J2", "Tiền thực nhận": "1", "Kỳ thanh toán": "x"},
                                       {"Mã vận đơn": "J3", "Tiền thực nhận": "1", "Kỳ thanh toán": "a-20240101-0101"}], file="f2")
    got = by(cash.clean_jte_cash(good.union(bad), TODAY), "delivery_orderid")
    assert (got["J1"].reconciliation_value, got["J1"].reconciliation_at) == (150, datetime(2024, 2, 1))
    assert got["J2"].reconciliation_at == got["J3"].reconciliation_at == datetime(2026, 1, 31)
    again = cash.clean_jte_cash(good.union(frame(spark, cash.JTE_CASH, rows, file="f3")), TODAY)
    assert [r.reconciliation_value for r in again.collect()] == [150, 150], "a second copy is not a second payment"
    with pytest.raises(Exception, match="not whole"):
        cash.clean_jte_cash(frame(spark, cash.JTE_CASH, [{"Mã vận đơn": "J", "Tiền thực nhận": "1.5", "Kỳ thanh toán": "x"}]), TODAY).collect()


def test_spx_cash(spark):
    line = {"Mã giao dịch": "t1", "Mã vận đơn": "X1", "Thời gian giao dịch": "2024/01/02 03:04:05", "Số tiền (VND)": "100"}
    good = frame(spark, cash.SPX_CASH, [line, {**line, "Mã giao dịch": "t2", "Mã vận đơn": "-", "Số tiền (VND)": "x"}])
    twice = frame(spark, cash.SPX_CASH, [{**line, "Mã giao dịch": "t3"}, {**line, "Mã giao dịch": "t3"}], file="f2")
    text = frame(spark, cash.SPX_CASH, [{**line, "Mã giao dịch": "t4", "Số tiền (VND)": "1.5"}], file="f3")
    got = cash.clean_spx_cash(good.union(twice).union(text)).collect()
    assert [(r.sessionid, r.delivery_orderid, r.reconciliation_value, r.courier) for r in got] == [("t1", "X1", 100, "SPX Express")]


def test_ghn_cash_and_coins(spark):
    amount = cash.GHN_CASH[1]
    rows = frame(spark, cash.GHN_CASH, [{"Mã đơn GHN": "NVS1", amount: "100"}, {"Mã đơn GHN": "NVS1", amount: "-30"}, {amount: "5"}])
    rows = rows.withColumns({"session_id": F.lit("COD_1"), "session_date": F.lit("05/02/2024")})
    other = frame(spark, cash.GHN_CASH, [{"Mã đơn GHN": "NVS2", amount: "1"}], file="f2").withColumns(
        {"session_id": F.lit("XXX"), "session_date": F.lit("05/02/2024")})
    undated = frame(spark, cash.GHN_CASH, [{"Mã đơn GHN": "NVS3", amount: "1"}], file="f3").withColumns(
        {"session_id": F.lit("COD_3"), "session_date": F.lit("?")})
    got = by(cash.clean_ghn_cash(rows.union(other).union(undated), TODAY), "delivery_orderid")
    assert set(got) == {"NVS1", "NVS3"}
    assert (got["NVS1"].reconciliation_value, got["NVS1"].reconciliation_at) == (70, datetime(2024, 2, 5))
    assert got["NVS3"].reconciliation_at == datetime(2026, 1, 31)
    moves = frame(spark, cash.GHN_COIN_MOVES, [
        {"Ngày": "05/02/2024 10:20", "Loại giao dịch": "Đền bù\n x", "Nội dung": "NVS1_PR", "Số tiền": "10"},
        {"Ngày": "05/02/2024 10:20", "Loại giao dịch": "Đền bù x", "Nội dung": "NVS1", "Số tiền": "5"}])
    row = cash.clean_ghn_coin_moves(moves, TODAY).first()
    assert (row.sessionid, row.reconciliation_value, row.reconciliation_at) == ("2024-02-05 10:20_denbux", 15, datetime(2024, 2, 5, 10, 20))


# ---- sheets

def test_customer_bank(spark):
    base = {"Ngày": "02/01/2024", "Người xác nhận": "", "Mã FT": "f", "Sđt khách bank": "912"}
    df = frame(spark, sheets.CUSTOMER_BANK, [
        {**base, "ID": "KB_1", "ID đơn hàng": "111 222", "Số tiền bank": "1.200.000đ", "Ghi chú": "x" * 255},
        {**base, "ID": "KB_2", "ID đơn hàng": "333", "Số tiền bank": "", "Ghi chú": "x" * 256},
        {**base, "ID": "KB_3", "ID đơn hàng": "444+\n555", "Số tiền bank": "500000", "Sđt khách bank": ""},
        {**base, "ID": "KB_4", "ID đơn hàng": " "}, {**base, "ID": "bad", "ID đơn hàng": "666", "Số tiền bank": "9"}])
    got = by(sheets.clean_customer_bank(df, block_rows=2), "bank_surrogateid")
    assert set(got) == {"KB_1", "KB_2", "KB_3"}
    assert (got["KB_1"].orderid, got["KB_1"].bankvalue, got["KB_1"].customerphonenumber) == ("111,222", 600000.0, "0912")
    assert (got["KB_2"].bankvalue, len(got["KB_2"].note), len(got["KB_1"].note)) == (600000.0, 254, 255)
    assert (got["KB_3"].orderid, got["KB_3"].bankvalue, got["KB_3"].customerphonenumber) == ("444,555", 500000.0, None)


def test_return_scans(spark):
    df = frame(spark, sheets.RETURN_SCANS, [
        {"Key": "STT", "Mã vận đơn": "Mã vận đơn", "Mã SP": "Mã SP"},
        {"Key": "k1", "NGÀY": "5", "THÁNG": "T6", "Mã vận đơn": "nvs123456789_pr", "Mã SP": "mdu1 "},
        {"Key": "k2", "NGÀY": "", "THÁNG": "", "Mã vận đơn": "", "Mã SP": "#N/A"},
        {"Key": "k3", "NGÀY": "06", "THÁNG": "", "Mã vận đơn": "820000000001-001", "Mã SP": "x"},
        {"Key": "k4", "NGÀY": "", "THÁNG": "", "Mã vận đơn": "", "Mã SP": ""}])
    got = by(sheets.clean_return_scans(df, 2026, block_rows=2), "scan_surrogateid")
    assert set(got) == {"k1", "k2", "k3"}
    assert (got["k1"].delivery_orderid, got["k1"].productid, got["k1"].scanat) == ("NVS123456789", "MDU1", date(2026, 6, 5))
    assert (got["k2"].delivery_orderid, got["k2"].productid, got["k2"].scanat) == ("NVS123456789", None, date(2026, 6, 5))
    assert (got["k3"].delivery_orderid, got["k3"].scanat) == ("820000000001", date(2026, 6, 6))


def test_scans_and_notes(spark):
    scans = frame(spark, sheets.DELIVERY_SCANS, [{"Mã vận đơn": " ab c", "Ngày bắn đơn": "2024-01-02"}, {"Mã vận đơn": ""}])
    assert [(r.delivery_orderid, r.scan_deliveryorder_at) for r in sheets.clean_delivery_scans(scans).collect()] == [("ABC", date(2024, 1, 2))]
    notes = frame(spark, sheets.HANDLING_NOTES, [
        {"Mã vận đơn": "P1", "Ghi chú 1": "a", "Ghi chú 2": ""}, {"Mã vận đơn": "Mã vận đơn"}, {"Mã vận đơn": "P1", "Ghi chú 1": "b"}])
    out = sheets.clean_handling_notes(notes).orderBy("row_no").collect()
    assert [(r.delivery_orderid, r.handleteam_note1, r.handleteam_note2) for r in out] == [("P1", "a", None), ("P1", "b", None)]


def test_catalogue(spark):
    lines = [{"Mã SP": f" mdu{i:04d}", "Giá nội bộ": "350k", "Mục đích": ""} for i in range(1000, 1010)]
    lines += [{"Mã SP": "MDU9999", "Giá nội bộ": "hỏi"}, {"Mã SP": "", "Giá nội bộ": "1k"}]
    df = frame(spark, sheets.CATALOGUE, lines)
    got = by(sheets.clean_catalogue(df, 10), "productid")
    assert len(got) == 11 and got["MDU1000"].retailprice == 350000 and got["MDU9999"].retailprice is None
    assert got["MDU1000"].cate_purpose is None
    with pytest.warns(UserWarning, match="nothing loaded"):
        assert sheets.clean_catalogue(df, 11).count() == 0


# ---- orders

def test_pos(spark, tmp_path):
    path = landing.jsonl(tmp_path / "pos.json", [
        {"info": {"id": 123, "createdAt": 1704042000, "status": 60, "privateDescription": "Đổi từ 123456789 DI = abc",
                  "description": "mdu1234", "createdByName": "Nguyễn"},
         "shippingAddress": {"name": "Đặng", "mobile": "0912", "cityId": 1, "districtId": 9},
         "carrier": {"name": "GHN", "carrierCode": "NVS1", "sendCarrierAt": 0},
         "channel": {"trafficSource": "FB - Đơn đổi", "saleChannel": 10}, "payment": {"transfer": {"amount": 5}},
         "products": [{"code": "mdu1-m", "price": 10, "quantity": 2, "discountAmount": 0}, {"price": 3, "quantity": 1}]},
        {"info": {"id": 124, "privateDescription": "x" * 300}, "channel": {"trafficSource": "Zalo"}, "products": []}])
    orders = read_landed_json(spark, path, pos.SCHEMA)
    maps = {"orderstatus": spark.createDataFrame([("60", "thanh cong")], "code string, label string"),
            "customer_cityaddress": spark.createDataFrame([("1", "cu", 0), ("1", "Ha Noi", 1)], "code string, label string, seq int")}
    got = by(pos.clean_pos_orders(orders, maps), "orderid")
    one, two = got["123"], got["124"]
    assert (one.customername, one.orderstatus, one.customer_cityaddress, one.platform) == ("dang", "thanh cong", "Ha Noi", "10")
    assert (one.orderparentsource, one.ordersource, one.cod_prepaid, one.senddelivery_at) == ("don doi", "fb", 5, None)
    assert (one.previousid_internalnote, one.previousid_customernote, one.is_wrongproduct) == ("123456789", "MDU1234", True)
    assert one.created_at == datetime(2024, 1, 1)
    assert (two.orderparentsource, two.ordersource, len(two.internalnote), two.is_wrongproduct) == ("di moi", "zalo", 254, False)
    lines = sorted(tuple(r) for r in pos.clean_pos_lines(orders).select("productid", "parentproductid", "orderid", "quantity").collect())
    assert lines == [("", "", "123", 1), ("MDU1-M", "MDU1", "123", 2)]


def test_shopee(spark, tmp_path):
    item = {"item_sku": "i", "model_sku": "MDU1-M", "model_id": 7, "item_id": 8, "model_quantity_purchased": 2,
            "model_original_price": 100, "model_discounted_price": 0}
    orders = read_landed_json(spark, landing.jsonl(tmp_path / "o.json", [
        {"order_sn": "A", "package_list": [{"package_number": "p1", "shipping_carrier": "Hỏa tốc"}], "create_time": 1704042000,
         "pickup_done_time": 0, "update_time": 1704042001, "order_status": "COMPLETED", "item_list": [item]},
        {"order_sn": "B", "package_list": [], "update_time": 5, "order_status": "SHIPPED", "item_list": []}]), shopee.ORDERS)
    escrows = read_landed_json(spark, landing.jsonl(tmp_path / "e.json", [
        {"order_sn": "A", "return_order_sn_list": ["r1", "r2"], "order_income": {"escrow_amount": 50, "items": [
            {"model_sku": "MDU1-M", "model_id": 7, "item_id": 8, "quantity_purchased": 2, "seller_discount": 30,
             "discount_from_voucher_seller": 4}]}}, {"order_sn": "B", "return_order_sn_list": []}]), shopee.ESCROWS)
    trackings = read_landed_json(spark, landing.jsonl(tmp_path / "t.json", [{"package_number": "p1", "tracking_number": ""}]), shopee.TRACKINGS)
    got = by(shopee.clean_shopee_orders(orders, escrows, trackings, "shop"), "orderid")
    assert (got["A"].courier, got["A"].returned_orderids, got["A"].delivery_orderid, got["A"].pickupat) == ("Hoa toc", "r1,r2", None, None)
    assert got["A"].completedat == datetime(2024, 1, 1, 0, 0, 1) and got["A"].collectedvalue_theory == 50
    assert (got["B"].packageid, got["B"].completedat, got["B"].returned_orderids) == (None, None, None)
    line = shopee.clean_shopee_lines(orders, escrows).first()
    assert (line.orderproduct_id, line.realprice, line.shopdiscount_allquantities) == ("7_8_2", 85.0, 4)
    with pytest.raises(Exception, match="without escrow line"):
        shopee.clean_shopee_lines(orders, escrows.filter("order_sn = 'B'")).collect()
    income = read_landed_json(spark, landing.jsonl(tmp_path / "i.json", [
        {"order_sn": "A", "released_amount": 45, "actual_payout_time": 1704042000}]), shopee.INCOMES)
    row = shopee.clean_shopee_income(income).first()
    assert (row.sessionid, row.reconciliation_at) == ("A_45_1704042000", datetime(2024, 1, 1))


def test_tiktok(spark, tmp_path):
    item = {"seller_sku": "S-1", "product_id": "p", "product_name": "n", "sku_name": "s", "original_price": "100",
            "seller_discount": "5", "platform_discount": ""}
    orders = read_landed_json(spark, landing.jsonl(tmp_path / "o.json", [
        {"id": "1", "shipping_provider": "J&T Hỏa", "create_time": 1704042000, "payment": {"original_shipping_fee": "", "shipping_fee": "7"},
         "recipient_address": {"district_info": [{"address_name": "Việt Nam"}, {"address_name": "Hà Nội"}]},
         "line_items": [item] * 5 + [{**item, "product_id": "q"}, {**item, "seller_sku": None}]},
        {"id": "2", "line_items": []}]), tiktok.ORDERS)
    fee = "buyer_paid_return_shipping_fee"
    returns = read_landed_json(spark, landing.jsonl(tmp_path / "r.json", [
        {"order_id": "1", "create_time": 1, "return_reason_text": "old"},
        {"order_id": "1", "create_time": 2, "return_reason_text": "new", "return_tracking_number": "t" * 51,
         "shipping_fee_amount": [{fee: "3", "seller_paid_return_shipping_fee": "x"}, {fee: "4", "seller_paid_return_shipping_fee": "1"}]}]), tiktok.RETURNS)
    got = by(tiktok.clean_tiktok_orders(orders, returns, "shop"), "orderid")
    one = got["1"]
    assert (one.return_reason, len(one.returned_trackingnumber), one.returnshippingfee_paidbybuyer, one.returnshippingfee_paidbyseller) == ("new", 49, 7, None)
    assert (one.original_shipping_fee, one.actual_shipping_fee, one.buyeraddress_lv1, one.buyeraddress_lv2) == (None, 7, "Ha Noi", None)
    assert (one.shipping_provider, one.create_time, got["2"].return_reason) == ("J&T Hoa", datetime(2024, 1, 1), None)
    lines = tiktok.clean_tiktok_lines(orders).collect()
    assert [(r.product_skuid, r.productid, r.quantity, r.shopdiscount_allquantities, r.tiktokdiscount_allquantities) for r in lines] == [("S-1", "p", 5, 25, 0)]


def test_tiktok_income(spark):
    names = tiktok.INCOME
    line = {c: "10" for c in names.values()} | {names["order_or_statement_id"]: "1", names["transactiontime"]: "2024/01/02", names["transactiontype"]: "Đơn hàng"}
    good = frame(spark, names.values(), [line])
    bad = frame(spark, names.values(), [line | {names["totalfee"]: "1.5", names["order_or_statement_id"]: "2"}], file="f2")
    rows = tiktok.clean_tiktok_income(good.union(bad)).collect()
    assert [(r.order_or_statement_id, r.transactiontime, r.transactiontype, r.totalfee) for r in rows] == [("1", date(2024, 1, 2), "Don hang", 10)]
