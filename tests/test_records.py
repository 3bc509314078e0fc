"""CSV records with line breaks, read in pieces: equal to a reader that has the whole file."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from orderloom.sources.landed import read_grid, read_landed_table, read_records

COLUMNS = ["a", "b c", "d"]
BITS = ["x", "chữ", '"', ",", "\n", "\r\n", " ", "12", '""', "\n\n"]


def write(path, rows, end="\n"):
    text = io.StringIO()
    out = csv.writer(text, lineterminator=end)
    out.writerow(["row_no", *COLUMNS])
    for i, row in enumerate(rows, 1):
        out.writerow([i, *row])
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.getvalue().encode())
    return str(path)


def random_rows(seed, n):
    r = random.Random(seed)
    return [["".join(r.choices(BITS, k=r.randrange(6))) if r.random() < 0.5 else f"plain {i}" for _ in COLUMNS] for i in range(n)]


@pytest.fixture(params=[64, 500, 1 << 27])
def pieces(spark, request):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    yield request.param
    for k, v in old.items():
        spark.conf.set(k, v)


def shown(text):
    return None if text == "" else text.replace("\r\n", "\n")


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_a_reader_of_whole_files(spark, tmp_path, pieces, seed):
    want = []
    for f, end in (("f1", "\n"), ("f2", "\r\n"), ("empty", "\n")):
        rows = random_rows(seed * 10 + len(want), 60 if f != "empty" else 0)
        write(tmp_path / "in" / f"{f}.csv", rows, end)
        want += [(i, *map(shown, row), f) for i, row in enumerate(rows, 1)]
    got = read_landed_table(spark, str(tmp_path / "in"), COLUMNS, multiline=True)
    name = F.regexp_extract("source_file", r"(\w+)\.csv$", 1).alias("f")
    key = lambda r: (r[-1], r[0])
    assert sorted((tuple(r) for r in got.select("row_no", "a", "`b c`", "d", name).collect()), key=key) == sorted(want, key=key)
    cells = read_grid(spark, str(tmp_path / "in"), multiline=True).filter("row_no IS NOT NULL").select("row_no", "cells", name).collect()
    assert sorted(((r.row_no, *r.cells, r.f) for r in cells), key=key) == sorted(want, key=key)


def test_a_file_that_ends_within_a_cell(spark, tmp_path, pieces):
    write(tmp_path / "in" / "good.csv", [["1", "two\nlines", "3"]] * 20)
    (tmp_path / "in" / "torn.csv").write_text('row_no,a,b c,d\n1,x,y,z\n2,"never closed,y,z\n3,x,y,z\n')
    with pytest.raises(Exception, match="ends within a quoted cell"):
        read_landed_table(spark, str(tmp_path / "in"), COLUMNS, multiline=True).collect()
    got = read_landed_table(spark, str(tmp_path / "in"), COLUMNS, multiline=True, mark=True).collect()
    assert {r.source_file[-8:] for r in got if r["__unreadable"]} == {"torn.csv"}
    assert sum(r["b c"] == "two\nlines" for r in got if not r["__unreadable"]) == 20


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path):
    line = ["x" * 100, "two\nlines of " + "y" * 100, 'quote " here']
    path = write(tmp_path / "big.csv", [line] * 80_000)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4 << 20)
    try:
        assert spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions() >= 4
        got = read_records(spark, path)
        assert got.count() == 80_001
        assert got.filter(~F.col("is_first")).select(F.regexp_replace("value", "^[0-9]+", "")).distinct().count() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
