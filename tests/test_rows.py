"""Row-order operators against a plain loop, and grouped operators."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rowsets import rows
from orderloom.operators import aggregates as agg
from orderloom.operators import windows as win


def sheet(n=400, seed=3):
    rnd = random.Random(seed)
    return [(f"s{i % 3 == 0}", i, rnd.choice([None, None, 1.0, 1.0, 2.0])) for i in range(n)]


def expected(data):
    out = []
    for name in {r[0] for r in data}:
        last, run, prev, first = None, 0, None, True
        part = []
        for _, no, v in sorted(r for r in data if r[0] == name):
            last = v if v is not None else last
            if first or last is None or prev is None or last != prev:
                run += 1
            part.append([name, no, last, run])
            prev, first = last, False
        for row in part:
            size = sum(1 for r in part if r[3] == row[3])
            out.append((row[0], row[1], row[2], row[3], None if row[2] is None else row[2] / size))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [1, 7, 64, 1000])
def test_fill_runs_split_over_blocks(spark, block):
    data = sheet()
    data[0] = ("sTrue", 0, None)
    df = spark.createDataFrame(data, "sheet string, row_no long, v double")
    filled = win.fill_down(df, ["v"], "sheet", block_rows=block)
    numbered = win.runs(filled, "v", "sheet", block_rows=block)
    split = win.split_even(filled, "v", "sheet", block_rows=block).select("sheet", "row_no", F.col("v").alias("part"))
    got = numbered.join(split, ["sheet", "row_no"]).select("sheet", "row_no", "v", "run_id", "part")
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(data)


def test_split_adds_up_per_run(spark):
    df = spark.createDataFrame(sheet(300, 9), "sheet string, row_no long, v double")
    filled = win.fill_down(df, ["v"], "sheet", block_rows=16)
    numbered = win.runs(filled, "v", "sheet", block_rows=16).dropna(subset=["v"])
    parts = win.split_even(filled, "v", "sheet", block_rows=16).select("sheet", "row_no", F.col("v").alias("part"))
    sums = numbered.join(parts, ["sheet", "row_no"]).groupBy("sheet", "run_id").agg(F.sum("part").alias("p"), F.max("v").alias("v"))
    assert sums.filter(F.abs(F.col("p") - F.col("v")) > 1e-9).count() == 0


def test_latest_first_duplicates(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 5, "z"), (None, 1, "n"), (None, 2, "m")], "k string, t long, v string")
    assert rows(win.latest_per_key(df, "k", [F.col("t")])) == [("a", 2, "y"), ("b", 5, "z"), (None, 2, "m")]
    assert rows(win.first_per_key(df, "k", [F.col("t")])) == [("a", 1, "x"), ("b", 5, "z"), (None, 1, "n")]
    assert win.duplicates(df, "k").count() == 4


def test_map_side_limit_for_hot_keys(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = win.latest_per_key(df, "k", [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_ordered_text(spark):
    df = spark.createDataFrame(
        [("a", "2024-01-02", "y"), ("a", "2024-01-01", "x"), ("a", "2024-02-01", None), ("b", "2024-01-01", None)],
        "k string, d string, v string").withColumn("d", F.to_date("d"))
    out = agg.ordered_text(df, ["k"], {"v2": F.col("v"), "d2": F.col("d")}, [F.col("d")])
    assert rows(out) == [("a", "x,y", "2024-01-01,2024-01-02,2024-02-01"), ("b", None, "2024-01-01")]


def test_totals_collapse_signed(spark):
    df = spark.createDataFrame([("a", 5), ("a", -3), ("b", 4), (None, 1)], "k string, v long")
    assert rows(df.groupBy("k").agg(*agg.signed_totals(F.col("v"), "x"))) == [("a", 5, -3), ("b", 4, None), (None, 1, None)]
    assert rows(agg.collapse(df, ["k"], ["v"], "n")) == [("a", 2, 2), ("b", 1, 4)]
    assert rows(agg.with_totals(df.dropna(), ["k"], {"t": F.col("v")})) == [("a", -3, 2), ("a", 5, 2), ("b", 4, 4)]


def test_allocation_adds_up(spark):
    df = spark.createDataFrame([(o, w) for o in range(50) for w in (1, 2, o % 3)], "o long, w long")
    df = agg.with_totals(df, ["o"], {"t": F.col("w")})
    sums = df.withColumn("part", agg.allocate(F.lit(1000.0), F.col("w"), F.col("t"))).groupBy("o").agg(F.sum("part").alias("s"))
    assert sums.filter(F.abs(F.col("s") - 1000) > 1e-6).count() == 0
    zero = spark.createDataFrame([(1, 0, 0)], "o long, w long, t long")
    assert zero.select(agg.allocate(F.lit(9.0), F.col("w"), F.col("t"))).first()[0] == 0.0


def test_hot_key_is_split(spark):
    """A join on a key that holds most rows is split by the adaptive plan, so no task gets the whole group."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "100k")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "50k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id"))
        df = spark.range(0, 200_000, 1, 16).select(F.nullif(hot, F.lit(-1)).alias("k"), F.xxhash64("id").alias("v"))
        out = agg.with_totals(df, ["k"], {"n": F.lit(1)})
        assert out.filter("k = 7 AND n < 133333").count() == 0
        top = out.agg(F.max("v"), F.max("n"))
        top.collect()
        assert "skew=true" in top._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
                    "spark.sql.adaptive.advisoryPartitionSizeInBytes"):
            spark.conf.unset(key)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("chunk", [3, 10_000])
def test_ordered_text_of_large_keys(spark, chunk):
    """Chunks of keys that are too large to sort whole give the same text: all rows of a month, ties, NULLs, equal rows, a NULL key."""
    at = datetime(2024, 1, 1)
    data = [("hot", at.replace(day=1 + i * 7 % 28), f"s{i % 9}", None if i % 4 == 0 else f"c{i % 5}") for i in range(90)]
    data += [("hot", at, "same", "same")] * 40 + [(None, at, f"n{i}", None) for i in range(7)] + [("one", at, "x", None), ("none", at, None, None)]
    df = spark.createDataFrame(data, "k string, d timestamp_ntz, s string, c string").repartition(3)
    want = {}
    for k in {r[0] for r in data}:
        of = [r for r in data if r[0] == k]
        texts = [",".join(r[i] for r in sorted((r for r in of if r[i] is not None), key=lambda r: (r[1], r[i]))) for i in (2, 3)]
        want[k] = tuple(t if any(r[i] is not None for r in of) else None for i, t in zip((2, 3), texts))
    got = agg.ordered_text(df, ["k"], {"s2": F.col("s"), "c2": F.col("c")}, [F.col("d")], chunk=chunk).collect()
    assert {r.k: (r.s2, r.c2) for r in got} == want and len(got) == len(want)


def test_ordered_text_has_no_group_beyond_a_chunk(spark):
    """The largest list any task builds holds a chunk of rows, or the pieces made of them."""
    df = spark.range(20_000).select(F.lit("hot").alias("k"), F.lit(datetime(2024, 1, 1)).alias("d"), F.col("id").cast("string").alias("s"))
    out = agg.ordered_text(df, ["k"], {"s2": F.col("s")}, [F.col("d")], chunk=1000)
    assert out.first().s2 == ",".join(sorted(map(str, range(20_000))))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") >= 1
