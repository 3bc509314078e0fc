"""Failure policies, marks and reports."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from rowsets import rows
from orderloom.operators import quality as q
from orderloom.operators import tracking as tr
from orderloom.operators import verdicts as v
from orderloom.plans import reports


@pytest.fixture
def df(spark):
    return spark.createDataFrame([("f1", "1", 1), ("f1", "x", 2), ("f2", "3", 3), ("f2", None, 4)], "source_file string, v string, n long")


def test_fail_warn_drop(df):
    bad = {"not a number": ~F.col("v").rlike(r"^\d+$")}
    with pytest.raises(Exception, match="must not be loaded: not a number"):
        q.fail_rows(df, bad).collect()
    assert q.fail_rows(df, {"negative": F.col("n") < 0}).count() == 4
    kept, rejected = q.expect_or_drop(df, F.col("v").rlike(r"^\d+$"))
    assert (kept.count(), rejected.count()) == (2, 2)


def test_coerce_fallback_reject_gate(df):
    assert [r[0] for r in df.select(q.coerce(F.col("v"))).collect()] == [1, 0, 3, 0]
    dated = df.withColumn("d", F.when(F.col("v") == "x", None).otherwise(F.lit(date(2024, 1, 1))))
    got = q.fallback_per_file(dated, "d", F.col("d").isNull(), F.lit(date(2026, 1, 1))).orderBy("n").collect()
    assert [r.d.year for r in got] == [2026, 2026, 2024, 2024]
    assert rows(v.drop_rejected(df, {"x": F.col("v") == "x"}, by_file="source_file").select("n")) == [(3,), (4,)]
    assert rows(v.drop_rejected(df, {"x": F.col("v") == "x"}).select("n")) == [(1,), (3,), (4,)]
    assert q.volume_gate(df, {"known": F.col("v").isNotNull()}, 3).count() == 4
    with pytest.warns(UserWarning):
        assert q.volume_gate(df, {"known": F.col("v").isNotNull()}, 4).count() == 0


def test_contracts(spark, df):
    q.assert_pk(df, ["n"])
    with pytest.raises(q.QualityError, match="repeated"):
        q.assert_pk(df, ["source_file"])
    with pytest.raises(q.QualityError, match="missing"):
        q.assert_not_null(df, ["v"])
    dim = spark.createDataFrame([("1",), ("x",)], "id string")
    with pytest.raises(q.QualityError):
        q.assert_fk(df, "v", dim, "id")
    q.assert_fk(df.filter("v <> '3'"), "v", dim, "id")


def test_marks(spark):
    log = tr.empty_log(spark)
    marks = tr.watermarks(log)
    assert marks["anything"] == tr.START
    df = spark.createDataFrame([("a", datetime(2024, 1, 1)), ("a", datetime(2024, 1, 2)), ("b", datetime(2024, 1, 1))],
                               "k string, dw_updatedat timestamp_ntz")
    assert tr.since(df, marks["t"]).count() == 3
    log = tr.advance(log, {"t": (df, "dw_updatedat"), "none": (df.filter("false"), "dw_updatedat")})
    assert rows(log) == [("t", datetime(2024, 1, 2))]
    again = tr.advance(log, {"t": (df, "dw_updatedat")})
    assert again.count() == 1
    marks = tr.watermarks(again)
    assert tr.since(df, marks["t"]).count() == 0, "a stamp equal to the mark is old"
    assert tr.changed_groups(df, ["k"], datetime(2024, 1, 1)).count() == 2


def test_mark_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    tr.stamp(spark.range(10), datetime(2024, 1, 1)).write.parquet(path)
    plan = tr.since(spark.read.parquet(path), datetime(2024, 1, 5))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(dw_updatedat" in plan


def test_reports(spark, tmp_path):
    tables = {"dim_order": spark.createDataFrame([("1", datetime(2024, 6, 1)), ("2", datetime(2024, 7, 1))], "orderid string, lastupdateat timestamp_ntz")}
    sql = "SELECT orderid, lastupdateat FROM dim_order WHERE month(lastupdateat) = :reportmonth"
    out = reports.run_report(spark, tables, sql, {"reportmonth": 6, "unused": 1}, str(tmp_path / "r"))
    assert out.count() == 1
    assert "2024-06-01 00:00:00" in "".join(p.read_text() for p in (tmp_path / "r").glob("*.csv"))
    with pytest.raises(q.QualityError):
        reports.run_report(spark, tables, "DELETE FROM dim_order")
    catalogue = spark.createDataFrame([("good", "YES", sql), ("off", "NO", sql), ("broken", "YES", "SELECT nothing FROM nowhere")],
                                      "name string, enabled string, sql string")
    with pytest.warns(UserWarning):
        state = reports.run_report_catalogue(spark, tables, catalogue, {"reportmonth": 7}, str(tmp_path / "all"))
    assert state["good"] == "ok" and state["off"] == "off" and state["broken"].startswith("failed")
