"""Sheets kept by hand: bank transfers, return scans, delivery scans, handling notes, catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.feeds.couriers import col
from orderloom.functions import scalar as s
from orderloom.functions.rules import is_not
from orderloom.operators.quality import enough, volume_gate
from orderloom.operators.relational import to_contract, union_all
from orderloom.operators.verdicts import Inspect, drop_rejected
from orderloom.operators.windows import BLOCK_ROWS, fill_down, split_even, with_group_size

# Columns of the sheets.
CUSTOMER_BANK = ("ID", "Ngày", "ID đơn hàng", "Sđt khách bank", "Số tiền bank", "Người xác nhận", "Mã FT", "Ghi chú")
RETURN_SCANS = ("Key", "NGÀY", "THÁNG", "Mã vận đơn", "Col1", "Mã SP")
DELIVERY_SCANS = ("Mã vận đơn", "Ngày bắn đơn")
HANDLING_NOTES = ("Mã vận đơn", *[f"Col{i}" for i in range(3, 13)], "Ghi chú 1", "Ghi chú 2", "Ghi chú 3")
CATEGORIES = {"cate_purpose": "Mục đích", "cate_color": "Màu sắc", "cate_fabric": "Chất liệu", "cate_collar": "Cổ váy",
              "cate_sleeve": "Tay váy", "cate_sleevelong": "Chiều dài tay", "cate_dresstype": "Kiểu váy",
              "cate_fabricpattern": "Mẫu vải"}
CATALOGUE = ("Mã SP", *[f"Col{i}" for i in range(2, 11)], "Giá nội bộ", *[f"Col{i}" for i in range(12, 30)],
             *CATEGORIES.values())
SHEET = "source_file"


def clean_customer_bank(sheet: DataFrame, block_rows: int = BLOCK_ROWS, inspect: Inspect = drop_rejected) -> DataFrame:
    """Transfers; an amount is written once for merged cells: fill it down and split it evenly (B18). Rows without an id of the form KB_1 are left out."""
    rows = sheet.withColumn("ID đơn hàng", s.comma_list(col("ID đơn hàng")))
    rows = rows.filter(is_not(col("ID đơn hàng"), ",") & is_not(col("ID đơn hàng"), ""))
    rows = inspect(rows, {"ID is not KB_ and digits": ~s.matches(col("ID"), r"^KB_\d+$")})
    rows = rows.withColumn("Số tiền bank", s.null_if_blank(s.drop_currency(col("Số tiền bank"), "$")).cast("double"))
    rows = fill_down(rows, ["Số tiền bank"], SHEET, block_rows=block_rows)
    rows = split_even(rows, "Số tiền bank", SHEET, block_rows=block_rows)
    phone = s.null_if_blank(col("Sđt khách bank"))
    return to_contract(rows, {
        "bank_surrogateid": "ID", "notedate": s.parse_time_strict(s.null_if_blank(col("Ngày")), "dd/MM/yyyy").cast("date"),
        "orderid": "ID đơn hàng",
        "customerphonenumber": F.when(phone.startswith("0"), phone).otherwise(F.concat(F.lit("0"), phone)),
        "bankvalue": "Số tiền bank", "verifybyperson": s.null_if_blank(col("Người xác nhận")),
        "ftcode": s.null_if_blank(col("Mã FT")), "note": s.null_if_blank(s.truncate_to(col("Ghi chú"), 255)),
        "row_no": "row_no"})


def clean_return_scans(sheet: DataFrame, year: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Scanned return pieces; parcel, day and month are written once and filled down."""
    parcel, sku = "Mã vận đơn", "Mã SP"
    kept = (is_not(col(parcel), "") | is_not(col(sku), "")) & is_not(col("Key"), "STT")
    rows = sheet.filter(kept).withColumns({
        parcel: s.null_if_blank(F.upper(s.drop_ws(col(parcel)))),
        sku: s.null_if(F.upper(s.drop_ws(col(sku))), "", "#N/A"),
        "NGÀY": s.null_if_blank(s.drop_ws(col("NGÀY"))),
        "THÁNG": s.null_if_blank(s.drop_ws(F.replace(F.lower(col("THÁNG")), F.lit("t"), F.lit(""))))})
    rows = fill_down(rows, [parcel, "NGÀY", "THÁNG"], SHEET, block_rows=block_rows)
    number = F.when(col(parcel).startswith("NVS"), s.drop_suffix(col(parcel), "_PR", 15)).otherwise(col(parcel))
    day = F.concat(F.lit(f"{year}-"), col("THÁNG"), F.lit("-"), col("NGÀY"))
    return to_contract(rows, {
        "scan_surrogateid": "Key", "scanat": s.parse_time_strict(day, "yyyy-M-d").cast("date"),
        "delivery_orderid": s.drop_suffix(number, "-001", 16), "productid": sku, "row_no": "row_no"})


def clean_delivery_scans(sheet: DataFrame) -> DataFrame:
    """Parcels scanned when they left."""
    rows = sheet.withColumn("Mã vận đơn", s.drop_ws(F.upper(col("Mã vận đơn")))).filter(is_not(col("Mã vận đơn"), ""))
    note = F.lit(None).cast("string")
    return to_contract(rows, {
        "delivery_orderid": "Mã vận đơn",
        "scan_deliveryorder_at": s.parse_time_strict(s.null_if_blank(col("Ngày bắn đơn")), "yyyy-MM-dd").cast("date"),
        "row_no": "row_no"}, {f"handleteam_note{i}": note for i in (1, 2, 3)})


def note_rows(*sheets: DataFrame) -> DataFrame:
    rows = union_all(*sheets)
    return rows.filter(is_not(col("Mã vận đơn"), "") & is_not(col("Mã vận đơn"), "Mã vận đơn"))


def clean_handling_notes(*sheets: DataFrame, inspect: Inspect | None = None) -> DataFrame:
    """Notes of the handling team, one sheet after the other (B20). Of parcels noted more than once the last note counts; an inspection reports them."""
    rows = note_rows(*sheets)
    if inspect is not None:
        rows = inspect(with_group_size(rows, ["Mã vận đơn"], "__notes"), {}, {"parcel is noted more than once": F.col("__notes") > 1})
    return to_contract(rows, {
        "delivery_orderid": "Mã vận đơn", "scan_deliveryorder_at": F.lit(None).cast("date"),
        **{f"handleteam_note{i}": s.null_if_blank(col(f"Ghi chú {i}")) for i in (1, 2, 3)}, "row_no": "row_no"})


def clean_catalogue(sheet: DataFrame, minimum: int = 1000, inspect: Inspect | None = None) -> DataFrame:
    """Listed products with price notes such as 350k; nothing at all if too few rows look right."""
    rows = sheet.withColumn("Mã SP", F.upper(s.drop_ws(col("Mã SP")))).filter(is_not(col("Mã SP"), ""))
    rows = rows.withColumn("price", s.thousands(col("Giá nội bộ")))
    right = {"sku": col("Mã SP").rlike(r"^MDU\d{4}$"), "price": F.col("price").isNotNull()}
    if inspect is None:
        rows = volume_gate(rows, right, minimum)
    else:  # counted by the write of the inspection, without a pass of its own
        rows = inspect(rows, {}, {f"no right {n}": ~F.coalesce(c, F.lit(False)) for n, c in right.items()})
        rows = rows if enough({n: inspect.last["rows"] - inspect.last[f"no right {n}"] for n in right}, minimum) else rows.filter("false")
    return to_contract(rows, {
        "productid": "Mã SP", "retailprice": "price", **{n: s.null_if_blank(col(c)) for n, c in CATEGORIES.items()},
        "row_no": "row_no"})
