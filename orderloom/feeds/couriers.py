"""Parcel files of the couriers and the self-delivery sheet -> deliveryorders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import scalar as s
from orderloom.functions.rules import out_of_range
from orderloom.operators.quality import coerce, fail_rows
from orderloom.operators.relational import lookup, to_contract, union_all
from orderloom.operators.verdicts import Inspect, any_of, drop_rejected

# The fee columns of the payment file.
GHTK_FEES = (
    "Phí giao hàng", "Phí khai giá", "Phí dễ vỡ", "Phí gia cố đơn hàng", "Phí thực phẩm khô", "Phí hàng nguyên hộp",
    "Phí quay lại điểm lấy hàng", "Phí bốc xếp 1 chiều, tầng trệt", "Phí bốc xếp 1 chiều, tầng lầu",
    "Phí bốc xếp 2 chiều, tầng trệt", "Phí thêm người bốc xếp", "Phí chờ trên mỗi điểm giao", "Phí thử hàng / đồng kiểm",
    "Phí thư tín, tài liệu", "Phí nguyên vật liệu", "Phí hoàn hàng", "Phí thay đổi địa chỉ giao", "Phí lưu kho",
    "Phí giao lại", "Phí đổi địa chỉ trả hàng", "Phí xuất trả lại", "Tiền tip COD", "Khuyến mãi",
)
# The other columns of the landed files.
GHTK_PARCELS = ("Mã ĐH", "Mã ĐH shop", "Trạng thái đơn hàng", "Thời gian tạo đơn", "Thời gian lấy thành công",
                "Thời gian giao hàng thành công", "Giá trị hàng hóa")
GHTK_PAYMENTS = ("STT", "Mã đơn hàng", "Tiền CoD", *GHTK_FEES)
GHTK_COMPENSATIONS = ("Mã đơn hàng", "Tiền bồi hoàn")
GHN_PARCELS = ("Mã đơn hàng", "Trạng thái", "Tổng phí dịch vụ", "Phí hoàn hàng", "Tiền COD", "GTB - Thu tiền",
               "Giá trị khai giá", "Mã đơn hàng riêng", "Ngày tạo đơn", "Ngày lấy hàng thành công",
               "Ngày giao hàng thành công", "Ngày giao hàng lần đầu", "Ngày thu GTB - thu tiền")
GHN_COINS = ("Loại giao dịch", "Nội dung", "Số tiền")
JTE_PARCELS = ("Mã vận đơn", "Trạng thái vận đơn", "Thời gian tạo đơn", "Cước phí", "Tiền thu hộ COD", "COD thực thu",
               "Mã đơn KH", "Thời gian lấy hàng", "Thời gian ký nhận", "Phí lưu kho")
SPX_PARCELS = ("Mã vận đơn", "Trạng thái hiện tại", "Số tiền COD", "Giá trị đơn hàng", "Phí vận chuyển thực tế",
               "Thời gian tạo đơn", "Thời gian lấy hàng/gửi hàng", "Thời gian giao hàng")
SELF_DELIVERY = ("STT", "Ngày lên", "Ngày đi", "Tên khách hàng", "Sđt khách hàng", "Mã hàng", "ID đơn", "SL đơn",
                 "SL váy", "Địa chỉ", "Trạng thái", "Tổng Cod", "Phí Ship", "Cod BANK", "Cod Tiền mặt", "NV đi đơn")
COIN_REFUND = "Đền bù hoặc chiết khấu"
LOST = "Hàng thất lạc"
SELF = "Tu Van Chuyen"


def col(name: str) -> Column:
    return F.col(f"`{name}`")


def whole(name: str) -> Column:
    """A number cell as whole dong; text that is no number fails the query."""
    return col(name).cast("double").cast("bigint")


def _not_digits(name: str) -> Column:
    return F.coalesce(col(name).rlike("[A-Za-z]"), F.lit(True))


def _parcels(df: DataFrame, fmt: str, row_no: str = "row_no", **cols) -> DataFrame:
    times = ("createdat", "pickupat", "completedat")
    mapping = {n: s.parse_time_strict(c, fmt) if n in times and isinstance(c, Column) else c for n, c in cols.items()}
    return to_contract(df, {**mapping, row_no: row_no})


def clean_ghtk_parcels(parcels: DataFrame, payments: DataFrame, cancelled: DataFrame | None = None,
                       compensations: DataFrame | None = None) -> DataFrame:
    """Parcels with cancelled ones, compensation and the sum of 23 fees (B1)."""
    status, refund = "Trạng thái đơn hàng", "Tiền bồi hoàn"
    if cancelled is not None:
        cancelled = cancelled.drop("courier", "courieraccount").withColumn(status, F.lit("Don huy"))
        parcels = union_all(parcels, cancelled)
    parcels = parcels.withColumn("Mã ĐH", s.last_chars(col("Mã ĐH"), 10))
    parcels = fail_rows(parcels, {"Mã ĐH is not 10 digits": _not_digits("Mã ĐH")})
    if compensations is None:
        parcels = parcels.withColumn(refund, F.lit(0).cast("bigint"))
    else:
        paid = compensations.select(s.last_chars(col("Mã đơn hàng"), 10).alias("id"), whole(refund).alias("refund"))
        paid = fail_rows(paid, {"compensation id is not 10 digits": _not_digits("id")})
        parcels = lookup(parcels, paid, {"Mã ĐH": "id"}, {"refund": refund})
        parcels = fail_rows(parcels, {"compensation is not above 0": col(refund) <= 0})
        parcels = parcels.withColumns({
            status: F.when(col(refund) > 0, F.lit("Boi hoan")).otherwise(col(status)),
            refund: s.zero_if_null(col(refund))})
    rows = payments.filter(s.matches(col("STT"), r"^\d+$"))
    rows = rows.select(s.last_chars(col("Mã đơn hàng"), 10).alias("id"), whole("Tiền CoD").alias("cod"),
                       s.sum_columns([whole(c) for c in GHTK_FEES], -1).alias("cost"))
    rows = fail_rows(rows, {"payment id is not 10 digits": _not_digits("id")})
    parcels = lookup(parcels, rows, {"Mã ĐH": "id"}, ["cod", "cost"])
    return _parcels(
        parcels, "yyyy-MM-dd HH:mm:ss", delivery_orderid="Mã ĐH", shop_orderid="Mã ĐH shop",
        orderstatus=s.fold_diacritics(col(status)), cod_collected="cod", cod_declared=whole("Giá trị hàng hóa"),
        shippingcost="cost", createdat=col("Thời gian tạo đơn"), pickupat=col("Thời gian lấy thành công"),
        completedat=col("Thời gian giao hàng thành công"), courier="courier", compensationvalue=refund,
        courieraccount="courieraccount")


def clean_ghn_parcels(parcels: DataFrame, coins: DataFrame, inspect: Inspect = drop_rejected) -> DataFrame:
    """Parcels with their coin credits; credits of lost parcels are compensation (B2). Fees that are no numbers count as 0."""
    paid = coins.filter(col("Loại giao dịch") == COIN_REFUND).select(
        s.drop_suffix(col("Nội dung"), "_PR").alias("id"), col("Số tiền").alias("amount"))
    paid = fail_rows(paid, {"coin amount is not whole": ~s.matches(col("amount").cast("string"), r"^-?\d+$")})
    paid = paid.groupBy("id").agg(F.sum(col("amount").cast("bigint")).alias("coins"))
    rows = parcels.filter(~F.coalesce(col("Mã đơn hàng").endswith("_PR"), F.lit(False)))
    amounts = ("Tổng phí dịch vụ", "Phí hoàn hàng", "Tiền COD", "GTB - Thu tiền")
    rows = fail_rows(rows, {f"{c} is missing": col(c).isNull() for c in amounts})
    rows = inspect(rows, {}, {f"{c} is no number, taken as 0": col(c).try_cast("double").isNull() for c in amounts[:2]})
    rows = lookup(rows, paid, {"Mã đơn hàng": "id"}, ["coins"])
    lost = col("Trạng thái") == LOST
    cod = whole("Tiền COD") + F.when(col("Ngày thu GTB - thu tiền").isNotNull(), whole("GTB - Thu tiền")).otherwise(0)
    return _parcels(
        rows, "dd/MM/yyyy", delivery_orderid="Mã đơn hàng", shop_orderid="Mã đơn hàng riêng",
        orderstatus=s.fold_diacritics(col("Trạng thái")),
        cod_collected=F.when(lost, F.lit(0).cast("bigint")).otherwise(cod + s.zero_if_null(col("coins"))),
        cod_declared=whole("Giá trị khai giá"),
        shippingcost=coerce(col("Tổng phí dịch vụ")) + coerce(col("Phí hoàn hàng")),
        createdat=col("Ngày tạo đơn"), pickupat=col("Ngày lấy hàng thành công"),
        completedat=F.coalesce(col("Ngày giao hàng thành công"), col("Ngày giao hàng lần đầu")), courier="courier",
        compensationvalue=F.when(lost, s.zero_if_null(col("coins"))).otherwise(F.lit(0).cast("bigint")),
        courieraccount="courieraccount")


def clean_jte_parcels(parcels: DataFrame) -> DataFrame:
    """Parcels; missing fees count as 0."""
    return _parcels(
        parcels, "yyyy-MM-dd HH:mm", delivery_orderid="Mã vận đơn", shop_orderid="Mã đơn KH",
        orderstatus=s.fold_diacritics(col("Trạng thái vận đơn")), cod_collected=whole("COD thực thu"),
        cod_declared=whole("Tiền thu hộ COD"),
        shippingcost=s.sum_columns([whole("Cước phí"), whole("Phí lưu kho")]), createdat=col("Thời gian tạo đơn"),
        pickupat=col("Thời gian lấy hàng"), completedat=col("Thời gian ký nhận"), courier="courier",
        compensationvalue=F.lit(0).cast("bigint"), courieraccount="courieraccount")


SPX_AMOUNTS = ("Số tiền COD", "Giá trị đơn hàng", "Phí vận chuyển thực tế")


def spx_doubts() -> dict[str, Column]:
    """Amounts that look wrong; the rows are loaded all the same."""
    return {**{f"{c} is below 3000 or above 1000000000": out_of_range(col(c).try_cast("double"), 3000, 1_000_000_000) for c in SPX_AMOUNTS},
            **{f"{c} is no number": col(c).isNotNull() & col(c).try_cast("double").isNull() for c in SPX_AMOUNTS}}


def spx_outliers(parcels: DataFrame) -> DataFrame:
    """Rows with an amount out of range."""
    return parcels.filter(any_of({n: c for n, c in spx_doubts().items() if "below" in n}))


def clean_spx_parcels(parcels: DataFrame, inspect: Inspect = drop_rejected) -> DataFrame:
    """Parcels; amounts that are no numbers and dashed dates are unknown."""
    parcels = inspect(parcels, {}, spx_doubts())
    cod, declared, cost = (col(c).try_cast("double").cast("bigint") for c in SPX_AMOUNTS)
    return _parcels(
        parcels, "yyyy-MM-dd HH:mm", delivery_orderid="Mã vận đơn", shop_orderid=F.lit(None).cast("string"),
        orderstatus=s.fold_diacritics(col("Trạng thái hiện tại")), cod_collected=cod, cod_declared=declared,
        shippingcost=cost, createdat=s.null_if(col("Thời gian tạo đơn"), "-"),
        pickupat=s.null_if(col("Thời gian lấy hàng/gửi hàng"), "-"),
        completedat=s.null_if(col("Thời gian giao hàng"), "-"), courier="courier",
        compensationvalue=F.lit(0).cast("bigint"), courieraccount="courieraccount")


def self_delivery_rows(sheet: DataFrame) -> DataFrame:
    """Sheet rows that hold an order: no blanks, no repeated headers."""
    sheet = sheet.withColumn("ID đơn", s.drop_ws(col("ID đơn")))
    return sheet.filter((F.coalesce(col("ID đơn"), F.lit("?")) != "") & ~col("STT").eqNullSafe(F.lit("STT")))


def clean_self_delivery(sheet: DataFrame, inspect: Inspect = drop_rejected) -> DataFrame:
    """Own deliveries with an order id of 9 digits, others are left out; the tracking number is made from it."""
    rows = inspect(self_delivery_rows(sheet), {"ID đơn is not 9 digits": ~s.matches(col("ID đơn"), r"^\d{9}$")})
    cell = {c: s.zero_if_null(s.money(col(c))) for c in ("Tổng Cod", "Phí Ship", "Cod BANK", "Cod Tiền mặt")}
    return _parcels(
        rows, "dd/MM/yyyy", delivery_orderid=F.concat(F.lit("TVC_GGSHEET_"), col("ID đơn")), shop_orderid="ID đơn",
        orderstatus=s.fold_diacritics(col("Trạng thái")),
        cod_collected=s.null_if(cell["Cod BANK"] + cell["Cod Tiền mặt"], 0),
        cod_declared=s.null_if(cell["Tổng Cod"], 0), shippingcost=cell["Phí Ship"], createdat=col("Ngày lên"),
        pickupat=col("Ngày đi"), completedat=F.lit(None).cast("string"), courier=F.lit(SELF),
        compensationvalue=F.lit(0).cast("bigint"), courieraccount=F.lit(SELF))
