"""Merge rules on keys that are new, equal, changed, emptied and repeated."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rowsets import rows
from orderloom.operators import merge as m
from orderloom.operators import relational as rel

T0, T1 = datetime(2024, 1, 1), datetime(2024, 2, 1)
SCHEMA = "k string, a string, b long, dw_updatedat timestamp_ntz"
TARGET = [("same", "x", 1, T0), ("changed", "x", 1, T0), ("to_null", "x", 1, T0), ("from_null", None, None, T0),
          ("old", "x", 1, T0)]
SOURCE = [("same", "x", 1), ("changed", "y", 1), ("to_null", None, 1), ("from_null", "x", 1), ("new", "z", 9)]


def frames(spark, source=SOURCE, target=TARGET):
    s = spark.createDataFrame([(*r, i) for i, r in enumerate(source)], "k string, a string, b long, row_no long")
    return spark.createDataFrame(target, SCHEMA), s.withColumn("dw_updatedat", F.lit(T1).cast("timestamp_ntz"))


def table(df):
    return {r.k: (r.a, r.b, r.dw_updatedat) for r in df.collect()}


def test_replace(spark):
    t, s = frames(spark)
    got = table(m.upsert(t, s, ["k"], order_col="row_no"))
    assert got == {"same": ("x", 1, T1), "changed": ("y", 1, T1), "to_null": (None, 1, T1), "from_null": ("x", 1, T1),
                   "old": ("x", 1, T0), "new": ("z", 9, T1)}


def test_changed_moves_stamp_only_on_difference(spark):
    t, s = frames(spark)
    got = table(m.upsert(t, s, ["k"], mode="changed", order_col="row_no"))
    assert got["same"][2] == T0 and got["old"][2] == T0
    assert {k for k, v in got.items() if v[2] == T1} == {"changed", "to_null", "from_null", "new"}


def test_coalesce_keeps_known_values(spark):
    t, s = frames(spark)
    got = table(m.upsert(t, s, ["k"], mode="coalesce", order_col="row_no"))
    assert got["to_null"] == ("x", 1, T0)
    assert got["from_null"] == ("x", 1, T1) and got["changed"] == ("y", 1, T1) and got["same"][2] == T0
    raw = table(m.upsert(t, s, ["k"], mode="coalesce", order_col="row_no", raw_compare=True))
    assert raw["to_null"] == ("x", 1, T1) and raw["same"][2] == T0


def test_repeated_keys_last_wins_and_any_difference_moves_the_stamp(spark):
    t, s = frames(spark, [("same", "q", 1), ("same", "x", 1), ("old", "x", 1), ("old", "x", 1), ("new", "1", 1), ("new", "2", 2)])
    got = table(m.upsert(t, s, ["k"], mode="changed", order_col="row_no"))
    assert got["same"] == ("x", 1, T1)
    assert got["old"] == ("x", 1, T0)
    assert got["new"] == ("2", 2, T1)
    parts = table(m.upsert(t, frames(spark, [("new", "1", None), ("new", None, 2)])[1], ["k"], mode="coalesce", order_col="row_no"))
    assert parts["new"] == ("1", 2, T1)


def sequential(target, source, mode):
    """The rule applied row by row."""
    state = {r[0]: list(r[1:]) for r in target}
    for k, a, b in source:
        if k not in state:
            state[k] = [a, b, T1]
            continue
        old = state[k]
        new = [a, b] if mode != "coalesce" else [a if a is not None else old[0], b if b is not None else old[1]]
        moved = mode == "replace" or new != old[:2]
        state[k] = [*new, T1 if moved else old[2]]
    return {k: tuple(v) for k, v in state.items()}


@pytest.mark.parametrize("mode", m.MODES)
def test_equals_row_by_row_merge(spark, mode):
    import random
    rnd = random.Random(7)
    values, numbers = [None, "x", "y"], [None, 1, 2]
    target = [(f"k{i}", rnd.choice(values), rnd.choice(numbers), T0) for i in range(60)]
    source = [(f"k{rnd.randrange(80)}", rnd.choice(values), rnd.choice(numbers)) for _ in range(240)]
    t, s = frames(spark, source, target)
    assert table(m.upsert(t, s, ["k"], mode=mode, order_col="row_no")) == sequential(target, source, mode)


@pytest.mark.parametrize("mode", m.MODES)
def test_merging_twice_changes_nothing(spark, mode):
    t, s = frames(spark)
    once = m.upsert(t, s, ["k"], mode=mode, order_col="row_no")
    assert table(m.upsert(once, s, ["k"], mode=mode, order_col="row_no")) == table(once)


def test_empty_sides(spark):
    t, s = frames(spark)
    assert table(m.upsert(t.filter("false"), s, ["k"], order_col="row_no")).keys() == {r[0] for r in SOURCE}
    assert table(m.upsert(t, s.filter("false"), ["k"], order_col="row_no")) == table(t)


def test_subset_defaults_and_kept_columns(spark):
    t = spark.createDataFrame([("a", "x", 1, 5)], "k string, s string, n long, fee long")
    s = spark.createDataFrame([("a", "y", 7), ("b", "z", None)], "k string, s string, n long")
    got = rows(m.upsert(t, s, ["k"], update_cols=["s"], insert_defaults={"fee": 0, "n": 3}, stamp_col=None))
    assert got == [("a", "y", 1, 5), ("b", "z", 3, 0)]


def test_errors(spark):
    t, s = frames(spark)
    with pytest.raises(ValueError, match="unknown merge mode"):
        m.upsert(t, s, ["k"], mode="swap")
    with pytest.raises(ValueError, match="not in target"):
        m.upsert(t, s.withColumn("zzz", F.lit(1)), ["k"])


def test_insert_ignore(spark):
    t = spark.createDataFrame([("a", 1)], "k string, n long")
    s = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    assert rows(m.insert_ignore(t, s, ["k"])) == [("a", 1), ("b", None)]


def test_feeds_equal_one_upsert_after_the_other(spark):
    target = spark.createDataFrame([("p1", "GHN", "s0", None), ("p9", "BEST", "s9", "n9")], "k string, courier string, status string, note string")
    one = spark.createDataFrame([("p1", "SPX", "s1"), ("p2", None, "s2")], "k string, courier string, status string")
    two = spark.createDataFrame([("p1", "late"), ("p3", "only")], "k string, note string")
    three = spark.createDataFrame([("p2", "J&T"), ("p2", "GHTK"), (None, "x")], "k string, courier string").withColumn(
        "__at", F.when(F.col("courier") == "J&T", "2").otherwise("1"))
    got = m.upsert_feeds(target, [(one, []), (two, []), (three, ["__at"])], ["k"], insert_defaults={"note": "-"})
    step = m.upsert(target, one, ["k"], stamp_col=None, insert_defaults={"note": "-"})
    step = m.upsert(step, two, ["k"], stamp_col=None, insert_defaults={"note": "-"})
    last = three.filter("courier = 'J&T'").drop("__at")
    step = m.upsert(step, last, ["k"], stamp_col=None, insert_defaults={"note": "-"})
    assert rows(got) == rows(step)
    assert ("p2", "J&T", "s2", "-") in rows(got)


def test_joined_update_and_deletes(spark):
    f = spark.createDataFrame([(1, "a", 10.0), (2, None, 20.0), (3, "zz", 30.0)], "id long, ref string, v double")
    o = spark.createDataFrame([("a", 5.0), ("b", 6.0)], "k string, w double")
    out = rel.update_from(f, o, {"ref": "k"}, {"v": lambda old, right: old + right("w")}, gate=F.col("id") < 9)
    assert rows(out) == [(1, "a", 15.0), (2, None, 20.0), (3, "zz", 30.0)]
    assert rows(rel.null_unmatched(f, "ref", o, "k")) == [(1, "a", 10.0), (2, None, 20.0), (3, None, 30.0)]
    assert rows(rel.delete_keys(f, o, {"ref": "k"})) == [(2, None, 20.0), (3, "zz", 30.0)]
    assert rows(rel.delete_where(f, F.col("ref") == "a")) == [(2, None, 20.0), (3, "zz", 30.0)]


def test_code_map(spark):
    df = spark.createDataFrame([("1",), ("2",), ("7",), (None,)], "c string")
    codes = spark.createDataFrame([("1", "mot", 0), ("2", "hai", 1), ("2", "Hai", 2)], "code string, label string, seq int")
    assert rows(rel.map_codes(df, "c", codes, "seq")) == [("Hai",), ("mot",), (None,), (None,)]
