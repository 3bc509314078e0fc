"""Column helpers on edge values."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from orderloom.functions import rules, scalar as s

def X():
    return F.col("x")


def check(spark, cases, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(cases)], f"i int, x {kind}")
    got = [r[0] for r in df.orderBy("i").select(fn(X())).collect()]
    assert got == [want for _, want in cases]


@pytest.mark.parametrize("fn,cases", [
    (s.fold_diacritics, [("Đền bù hoặc chiết khấu", "Den bu hoac chiet khau"), ("Hàng thất lạc", "Hang that lac"),
                         ("ß Æon œuvre Łódź", "ss AEon oeuvre Lodz"), ("é", "e"), ("a – b…", "a - b..."), (None, None)]),
    (s.strip_ws, [(" \t a b\n", "a b"), ("", "")]),
    (s.drop_ws, [(" a\tb\nc ", "abc")]),
    (s.drop_currency, [("1.200.000 đ", "1200000"), ("", "")]),
    (s.comma_list, [(" 111 222+333\n444-5 ", "111,222,333,444,5"), ("+", ","), ("", "")]),
    (s.sku_prefix, [("MDU1-M-RED", "MDU1"), ("MDU1", "MDU1"), ("", ""), (None, None)]),
    (s.head_before_last, [("fb - ads - don doi", "fb - ads "), ("fb", "fb")]),
    (lambda c: s.last_chars(c, 3), [("abcdef", "def"), ("ab", "ab")]),
    (lambda c: s.drop_suffix(c, "_PR", 6), [("NVS_PR", "NVS"), ("NVS1_PR", "NVS1_PR"), ("abcdef", "abcdef"), (None, None)]),
    (lambda c: s.truncate_to(c, 5), [("12345", "12345"), ("123456", "1234"), (None, None)]),
    (lambda c: s.extract(c, r"(\b\d{9}\b)"), [("id 123456789.", "123456789"), ("1234567890", None), (None, None)]),
    (lambda c: s.extract(F.lower(c), r"(mdu[1-9]{4})"), [("MDU1234 x", "mdu1234"), ("mdu1034", None)]),
    (s.null_if_blank, [("", None), ("a", "a")]),
])
def test_text(spark, fn, cases):
    check(spark, cases, fn)


def test_numbers(spark):
    check(spark, [("1.200 đ", 1200), ("", None), (None, None)], s.money)
    check(spark, [("350k", 350000), ("Giá 350K lẻ", 350000), ("350", None), ("2k5k", 2000)], s.thousands)
    check(spark, [("12", 12), ("x", None), (None, None)], s.whole_number)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        check(spark, [("abc", 0)], s.money)
    df = spark.createDataFrame([(1, 2), (0, 0), (None, 3)], "a int, b int")
    assert [r[0] for r in df.select(s.safe_ratio(F.col("a"), F.col("b"))).collect()] == [0.5, 0.0, None]
    assert [r[0] for r in df.select(s.sum_columns([F.col("a"), F.col("b")], -1)).collect()] == [-3, 0, -3]


def test_times(spark):
    check(spark, [(1704042000, datetime(2024, 1, 1, 0, 0)), (1704041999, datetime(2023, 12, 31, 23, 59, 59)), (None, None)],
          s.local_time, "long")
    check(spark, [(datetime(2024, 1, 1), 1704042000)], s.epoch_seconds, "timestamp_ntz")
    check(spark, [("31/01/2024", date(2024, 1, 31)), ("x", None), (None, None)], lambda c: s.parse_date(c, "dd/MM/yyyy"))
    with pytest.raises(Exception, match="not a time"):
        check(spark, [("x", None)], lambda c: s.parse_time_strict(c, "dd/MM/yyyy"))


def test_times_do_not_depend_on_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        check(spark, [(1704042000, datetime(2024, 1, 1))], s.local_time, "long")
        check(spark, [(datetime(2024, 1, 1), 1704042000)], s.epoch_seconds, "timestamp_ntz")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_arrays(spark):
    df = spark.createDataFrame([([{"f": "1"}, {"f": "2"}], ["a", "b"]), ([{"f": "x"}], []), ([], None), (None, None)],
                               "a array<struct<f string>>, t array<string>")
    got = [tuple(r) for r in df.select(s.sum_array(F.col("a"), "f"), s.list_text(F.col("t"))).collect()]
    assert got == [(3, "a,b"), (None, None), (0, None), (None, None)]


def test_rules(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    assert df.filter(rules.is_not(X(), "a")).count() == 2
    assert df.filter(rules.not_in(X(), ["a"])).count() == 1
    assert [r[0] for r in df.select(rules.rule_cascade([(X() == "a", 1), (X().isNull(), 2)], 3)).collect()] == [1, 3, 2]
    assert [r[0] for r in df.select(rules.differs([X()], [F.lit("a")])).collect()] == [False, True, True]
    nums = spark.createDataFrame([(0,), (2999,), (3000,), (1_000_000_001,)], "x long")
    assert [r[0] for r in nums.select(rules.out_of_range(X(), 3000, 10**9)).collect()] == [False, True, False, True]
