"""Cash sessions of the couriers -> delivery_reconciliation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.feeds.couriers import col
from orderloom.functions import scalar as s
from orderloom.functions.rules import is_not
from orderloom.operators.quality import fallback_per_file
from orderloom.operators.relational import to_contract
from orderloom.operators.verdicts import Inspect, any_of, drop_rejected, fail_rejected, unreadable
from orderloom.operators.windows import with_group_size

# Columns and cells of the landed files.
JTE_CASH = ("Mã vận đơn", "Tiền thực nhận", "Kỳ thanh toán")
SPX_CASH = ("Mã giao dịch", "Mã vận đơn", "Thời gian giao dịch", "Số tiền (VND)")
GHN_CASH = ("Mã đơn GHN", "(1) + (2) + (3) + (4) + (5)")
GHN_CASH_CELLS = {"session_id": (8, 1), "session_date": (9, 1)}
GHN_COIN_MOVES = ("Ngày", "Loại giao dịch", "Nội dung", "Số tiền")
PARCEL_ID = r"^(NVS\d{9}|G[a-z0-9]{7})$"


def any_unreadable(rows: DataFrame) -> Column:
    """Rows that stand for a part of a file that could not be read stay until they are judged."""
    return any_of(unreadable(rows))


def _whole(name: str) -> Column:
    return ~s.matches(col(name).cast("string"), r"^-?\d+$")


def _cash(df: DataFrame, courier: str, **cols) -> DataFrame:
    """Contract columns; row_no orders the batch by file and row, so that a file loaded again replaces its rows."""
    place = F.concat_ws(" ", "source_file", F.lpad(F.col("row_no").cast("string"), 19, "0"))
    return to_contract(
        df, {"sessionid": cols["sessionid"], "delivery_orderid": cols["delivery_orderid"],
             "reconciliation_value": cols["value"], "reconciliation_at": cols["at"], "row_no": place},
        {"courier": courier, "reconciliation_content": F.lit(None).cast("string")})


def _sums(rows: DataFrame, keys: list[str], amount: Column) -> DataFrame:
    """Sums per key inside each file. The same key in another file is a second copy, not a second payment."""
    return rows.dropna(subset=keys).groupBy("source_file", *keys).agg(
        F.min("at").cast("timestamp_ntz").alias("at"), F.sum(amount.cast("bigint")).alias("value"),
        F.max("row_no").alias("row_no"))


def _odd_parcel(name: str) -> dict[str, Column]:
    """A parcel id of neither known form; such rows are loaded all the same."""
    return {f"{name} has neither form of a parcel id": ~s.matches(col(name), PARCEL_ID, ignore_case=True)}


def clean_jte_cash(cash: DataFrame, run_date: date, inspect: Inspect = fail_rejected) -> DataFrame:
    """Sums per parcel and session; paid on the day after the session date. A file with a session code
    of another form is dated today as a whole (B14). One amount that is not whole spoils its file."""
    rows = cash.filter(is_not(col("Mã vận đơn"), "Tổng cộng") | any_unreadable(cash))
    rows = inspect(rows, {**unreadable(rows), "Tiền thực nhận is not whole": _whole("Tiền thực nhận")},
                   {"Kỳ thanh toán has no date, dated today": ~F.coalesce(col("Kỳ thanh toán").contains("-"), F.lit(False))}, by_file="source_file")
    code = col("Kỳ thanh toán")
    year, day = F.split_part(code, F.lit("-"), F.lit(2)), F.split_part(code, F.lit("-"), F.lit(3))
    text = F.concat_ws("-", F.substring(year, 1, 4), F.substring(day, 1, 2), F.substring(day, 3, 100))
    paid_on = F.when(code.contains("-"), F.date_add(s.parse_date(text, "yyyy-M-d"), 1))
    rows = rows.withColumn("at", paid_on)
    rows = fallback_per_file(rows, "at", F.col("at").isNull(), F.lit(run_date))
    sums = _sums(rows, ["Mã vận đơn", "Kỳ thanh toán"], col("Tiền thực nhận"))
    return _cash(sums, "JT Express", sessionid="Kỳ thanh toán", delivery_orderid="Mã vận đơn", value="value", at="at")


def clean_spx_cash(cash: DataFrame, inspect: Inspect = drop_rejected) -> DataFrame:
    """Transactions that belong to a parcel; files with unsound rows are left out: amounts that are not whole, or a transaction id twice in one file."""
    rows = with_group_size(cash.filter(is_not(col("Mã vận đơn"), "-") | any_unreadable(cash)), ["source_file", "Mã giao dịch"], "__times")
    rows = inspect(rows, {**unreadable(rows), "Số tiền (VND) is not whole": _whole("Số tiền (VND)"), "Mã giao dịch stands twice in the file": F.col("__times") > 1},
                   by_file="source_file")
    return _cash(rows, "SPX Express", sessionid="Mã giao dịch", delivery_orderid="Mã vận đơn",
                 value=col("Số tiền (VND)").cast("bigint"),
                 at=s.parse_time_strict(col("Thời gian giao dịch"), "yyyy/MM/dd HH:mm:ss"))


def clean_ghn_cash(cash: DataFrame, run_date: date, inspect: Inspect = drop_rejected) -> DataFrame:
    """Sums per parcel and session; session id and date come from cells above the table.

    Files whose session id is no COD session, or that hold amounts that are not whole, are left out.
    """
    amount = "(1) + (2) + (3) + (4) + (5)"
    rows = cash.filter(col("Mã đơn GHN").isNotNull() | any_unreadable(cash)).withColumn("at", s.parse_date(F.col("session_date"), "dd/MM/yyyy"))
    rows = inspect(rows, {**unreadable(rows), "the session is no COD session": ~F.coalesce(F.col("session_id").startswith("COD_"), F.lit(False)),
                          f"{amount} is not whole": _whole(amount)},
                   {**_odd_parcel("Mã đơn GHN"), "the session has no date, dated today": F.col("at").isNull()}, by_file="source_file")
    rows = fallback_per_file(rows, "at", F.col("at").isNull(), F.lit(run_date))
    sums = _sums(rows, ["Mã đơn GHN", "session_id"], col(amount))
    return _cash(sums, "Giao Hàng Nhanh", sessionid="session_id", delivery_orderid="Mã đơn GHN", value="value", at="at")


def clean_ghn_coin_moves(moves: DataFrame, run_date: date, inspect: Inspect = fail_rejected) -> DataFrame:
    """Sums of coin movements per parcel and session; the session is made of minute and kind."""
    day = col("Ngày")
    kind = s.fold_diacritics(s.drop_ws(F.lower(col("Loại giao dịch"))))
    session = F.concat(F.substring(day, 7, 4), F.lit("-"), F.substring(day, 4, 2), F.lit("-"), F.substring(day, 1, 2),
                       F.lit(" "), s.last_chars(day, 5), F.lit("_"), kind)
    rows = moves.withColumn("Nội dung", s.drop_suffix(col("Nội dung"), "_PR")).withColumn("at", s.parse_time(day, "dd/MM/yyyy HH:mm"))
    rows = inspect(rows, {**unreadable(rows), "Số tiền is not whole": _whole("Số tiền")},
                   {**_odd_parcel("Nội dung"), "Ngày is no time, dated today": F.col("at").isNull()}, by_file="source_file")
    rows = rows.select("source_file", "row_no", col("Nội dung").alias("parcel"), session.alias("session"), col("Số tiền").alias("amount"), "at")
    rows = fallback_per_file(rows, "at", F.col("at").isNull(), F.lit(run_date).cast("timestamp_ntz"))
    sums = _sums(rows, ["parcel", "session"], F.col("amount"))
    return _cash(sums, "Giao Hàng Nhanh", sessionid="session", delivery_orderid="parcel", value="value", at="at")
