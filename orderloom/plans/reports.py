"""Parameterised SQL reports over the star."""

from __future__ import annotations

import re
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators.quality import assert_select
from orderloom.operators.relational import keep_keys

MONTH_CHANNEL = """
SELECT date_format(o.createdat, 'yyyy-MM') AS month, o.platform, f.finalstatus, count(*) AS n_lines,
       sum(f.quantity) AS pieces, sum(f.return_quantity) AS pieces_back,
       sum(f.quantity * f.originalprice) AS order_value
FROM fact_orderdetails f JOIN dim_order o ON f.orderid = o.orderid
WHERE o.createdat >= make_timestamp_ntz(:year, 1, 1, 0, 0, 0) AND o.createdat < make_timestamp_ntz(:year + 1, 1, 1, 0, 0, 0)
GROUP BY ALL
"""

RETURN_RATE = """
SELECT p.cate_purpose, count(*) AS n_lines,
       count_if(f.finalstatus IN ('Hoan', 'Hoan mot phan')) AS n_back,
       count_if(f.finalstatus IN ('Hoan', 'Hoan mot phan')) / count(*) AS return_rate
FROM fact_orderdetails f JOIN dim_order o ON f.orderid = o.orderid
LEFT JOIN dim_product p ON f.parentproductid = p.productid
WHERE o.createdat >= make_timestamp_ntz(:year, :month, 1, 0, 0, 0)
  AND o.createdat < add_months(make_date(:year, :month, 1), 1)
GROUP BY p.cate_purpose
"""

SHIPPING_BY_COURIER = """
SELECT d.courier, d.courieraccount, count(DISTINCT f.deliveryid) AS n_parcels, sum(f.shippingfee) AS shippingfee,
       sum(f.cod_collected_allquantity) AS cod
FROM fact_orderdetails f JOIN dim_delivery d ON f.deliveryid = d.trackingnumber
JOIN dim_order o ON f.orderid = o.orderid
WHERE o.createdat >= make_timestamp_ntz(:year, :month, 1, 0, 0, 0)
  AND o.createdat < add_months(make_date(:year, :month, 1), 1)
GROUP BY d.courier, d.courieraccount
"""

UNRECONCILED = """
SELECT f.orderid, min(f.transaction_orderid) AS transaction_orderid,
       sum(f.cod_collected_allquantity) AS expected, sum(f.positive_reconciliation_allquantity) AS received
FROM fact_orderdetails f JOIN dim_order o ON f.orderid = o.orderid
WHERE f.finalstatus IN ('Thanh cong', 'Hoan mot phan') AND o.createdat >= make_timestamp_ntz(:year, :month, 1, 0, 0, 0)
  AND o.createdat < add_months(make_date(:year, :month, 1), 1)
GROUP BY f.orderid
HAVING coalesce(sum(f.positive_reconciliation_allquantity), 0) < sum(f.cod_collected_allquantity)
"""

REPORTS = {"month_channel": MONTH_CHANNEL, "return_rate": RETURN_RATE, "shipping_by_courier": SHIPPING_BY_COURIER,
           "unreconciled": UNRECONCILED}


def of_month(tables: dict[str, DataFrame], year: int, month: int) -> dict[str, DataFrame]:
    """The star with the fact lines of the orders of one month, for a report of that month that joins lines by another key first.

    A built fact lies by order: picked there, the lines of other months are not shuffled for the report.
    """
    start = F.make_timestamp_ntz(*[F.lit(n) for n in (year, month, 1, 0, 0, 0)])
    end = F.add_months(F.make_date(F.lit(year), F.lit(month), F.lit(1)), 1)
    orders = tables["dim_order"].filter((F.col("createdat") >= start) & (F.col("createdat") < end))
    return {**tables, "fact_orderdetails": keep_keys(tables["fact_orderdetails"], orders, "orderid", aligned=True)}


def run_report(spark: SparkSession, tables: dict[str, DataFrame], sql: str, params: dict | None = None,
               out_path: str | None = None, one_file: bool = False) -> DataFrame:
    """Run one SELECT over the given tables; with a path, also write it there as CSV.

    one_file: for a sheet of a few rows; all rows then pass one task after the report is computed.

    Parameters are named (:year) and never pasted into the text.
    """
    text = assert_select(sql)
    used = {k: v for k, v in (params or {}).items() if re.search(rf":{k}\b", text)}
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    result = spark.sql(text, args=used)
    if out_path is not None:
        rows = sheet_types(result)
        (rows.repartition(1) if one_file else rows).write.mode("overwrite").option("header", True).csv(out_path)
    return result


def sheet_types(df: DataFrame) -> DataFrame:
    """Decimals as numbers, dates and times as text."""
    def plain(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double")
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return F.col(field.name).cast("string").alias(field.name)
        return F.col(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def run_report_catalogue(spark: SparkSession, tables: dict[str, DataFrame], catalogue: DataFrame,
                         params: dict | None, out_root: str) -> dict[str, str]:
    """Run all enabled rows of a catalogue (name, enabled, sql); a failing report does not stop the others.

    Returns the state of every report. The catalogue is a list of SQL texts, not data.
    """
    state = {}
    for row in catalogue.select("name", "enabled", "sql").collect():
        if row.enabled != "YES":
            state[row.name] = "off"
            continue
        try:
            run_report(spark, tables, row.sql, params, f"{out_root}/{row.name}")
            state[row.name] = "ok"
        except Exception as error:
            warnings.warn(f"report {row.name} failed: {error}", stacklevel=2)
            state[row.name] = f"failed: {type(error).__name__}"
    return state
