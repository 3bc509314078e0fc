"""Readers of landed files.

Sheets and workbooks land as CSV whose first column `row_no` is the row number in the sheet, because
row order has a meaning (fill-down, preambles, last wins) and files are read in parallel pieces.
API answers land as JSON lines. A folder is one scan, however many files it holds.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE = "source_file"
UNREADABLE = "__unreadable"  # why a row could not be read, where faults are marked instead of raised


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField("row_no", T.LongType()), *[T.StructField(c, T.StringType()) for c in columns]])


def _guarded(df: DataFrame, path_tokens: tuple[str, ...], exclude_name_chars: str, bad_path: str) -> DataFrame:
    """Skip repeated downloads by file name; fail on (or skip) files whose path lacks a token it must contain."""
    for char in exclude_name_chars:
        df = df.filter(~F.col("_metadata.file_name").contains(char))
    path = F.lower(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))
    df = df.withColumn(FILE, path)
    for token in path_tokens:
        found = F.col(FILE).contains(token.lower())
        if bad_path == "fail":
            text = F.concat(F.lit(f"path must contain {token!r}: "), FILE)
            found = F.when(found, found).otherwise(F.raise_error(text).cast("boolean"))
        df = df.filter(found)
    return df


def _tagged(df: DataFrame, source: str | None, account: str | None) -> DataFrame:
    if source is not None:
        df = df.withColumn("courier", F.lit(source))
    if account is not None:
        df = df.withColumn("courieraccount", F.lit(account))
    return df


def read_records(
    spark: SparkSession, path: str | list[str], *, path_tokens: tuple[str, ...] = (), exclude_name_chars: str = "(",
    bad_path: str = "fail", mark: bool = False,
) -> DataFrame:
    """Records of CSV texts whose quoted cells may hold line breaks: value, is_first (of its file), source_file. A file is read in pieces.

    A line break is inside a cell if the quotes before it are odd in number. Pieces of a file are counted side by side; a prefix over one row per
    piece says how the quotes stand, and which record is open, where a piece begins. Lines that are records by themselves stay where they
    are, the others are strung together by the line their record starts with, across the borders of pieces. A file that
    ends within a cell is an error; mark: its rows say so in a column __unreadable. Cells with quotes have to be quoted, as writers of CSV do.
    """
    lines = _guarded(spark.read.option("lineSep", "\n").text(path), path_tokens, exclude_name_chars, bad_path)
    lines = lines.select(FILE, F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.regexp_replace("value", "\r$", "").alias("value"))
    quotes = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2
    piece = Window.partitionBy(FILE, "block").orderBy("at")
    so_far = piece.rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("odd", quotes).withColumn("inside", (F.sum("odd").over(so_far) - F.col("odd")) % 2)
    pieces = lines.groupBy(F.col(FILE).alias("file_"), F.col("block").alias("block_")).agg(
        (F.sum("odd") % 2).alias("odd_"), *[F.max(F.when(F.col("inside") == i, F.col("at"))).alias(f"last{i}") for i in (0, 1)])
    before = Window.partitionBy("file_").orderBy("block_").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("begins", F.coalesce(F.sum("odd_").over(before), F.lit(0)) % 2)
    pieces = pieces.withColumn("last", F.when(F.col("begins") == 0, F.col("last0")).otherwise(F.col("last1")))
    pieces = pieces.withColumn("open", F.last("last", ignorenulls=True).over(before)).withColumn(
        "torn", F.sum("odd_").over(Window.partitionBy("file_")) % 2 == 1)
    lines = lines.join(pieces.drop("odd_", "last0", "last1", "last"), (F.col(FILE) == F.col("file_")) & (F.col("block") == F.col("block_"))).drop("file_", "block_")
    lines = lines.withColumn("inside", (F.col("inside") + F.col("begins")) % 2).withColumn("is_first", (F.col("block") == 0) & (F.row_number().over(piece) == 1))
    record = F.coalesce(F.last(F.when(F.col("inside") == 0, F.col("at")), ignorenulls=True).over(so_far), F.col("open"))
    lines = lines.withColumn("record", record)
    if mark:
        lines = lines.withColumn(UNREADABLE, F.when(F.col("torn"), "the file ends within a quoted cell"))
    else:
        torn = F.raise_error(F.concat(F.lit("a file ends within a quoted cell: "), FILE)).cast("boolean")
        lines = lines.filter(F.when(F.col("torn"), torn).otherwise(F.lit(True)))
    kept = ["value", "is_first", FILE, *([UNREADABLE] if mark else [])]
    alone = ((F.col("inside") == 0) & (F.col("odd") == 0)) | F.col("torn")
    parts = F.transform(F.array_sort(F.collect_list(F.struct("block", "at", "value"))), lambda x: x["value"])  # the lines of one record
    strung = lines.filter(~alone).groupBy(FILE, "record").agg(
        F.array_join(parts, "\n").alias("value"), F.max("is_first").alias("is_first"), *([F.max(UNREADABLE).alias(UNREADABLE)] if mark else []))
    return lines.filter(alone).select(*kept).unionByName(strung.select(*kept))


def _cells(value: Column) -> Column:
    """The cells of a CSV record; empty ones are NULL unless quoted."""
    return F.transform(F.regexp_extract_all(F.concat(F.lit(","), value), F.lit(CELL), F.lit(1)), lambda x: F.when(
        F.startswith(x, F.lit('"')), F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).when(x != "", x))


# A cell of a record that has a comma put in front.
CELL = r',("(?:[^"]++|"")*+"|[^,]*+)'

# A line that ends within a quoted cell.
OPEN = r'^(?:(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+|),)*+"(?:[^"]++|"")*+$'


def read_landed_table(
    spark: SparkSession, path: str | list[str], columns: list[str], *, path_tokens: tuple[str, ...] = (),
    exclude_name_chars: str = "(", bad_path: str = "fail", source: str | None = None, account: str | None = None,
    types: dict[str, str] | None = None, multiline: bool = False, mark: bool = False,
) -> DataFrame:
    """Sheet ranges and tables with their header in the first line: all text, plus row_no and source_file.

    columns    the columns of the file in file order, after row_no
    bad_path   "fail" or "skip" files whose path lacks one of the tokens
    types      columns to cast strictly
    multiline  cells may hold line breaks, at the cost of a shuffle of the text; without it a line that ends within a
               quoted cell is an error, not a broken row
    mark       do not raise that error: the row says it in a column __unreadable, so that other files can be loaded
    """
    if multiline:
        records = read_records(spark, path, path_tokens=path_tokens, exclude_name_chars=exclude_name_chars, bad_path=bad_path, mark=mark)
        records = records.filter(~F.col("is_first") & (F.col("value") != "")).withColumn("cells", _cells(F.col("value")))
        df = records.select(F.get("cells", F.lit(0)).try_cast("bigint").alias("row_no"), *[F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(columns, 1)],
                            FILE, *([UNREADABLE] if mark else []))
    else:  # a column that no file has makes the reader keep the line of every row
        schema = text_schema(columns).add("__none", T.StringType()).add("__line", T.StringType())
        reader = spark.read.schema(schema).option("header", True).option("enforceSchema", True)
        reader = reader.option("columnNameOfCorruptRecord", "__line").option("columnPruning", False)
        df = _guarded(reader.option("escape", '"').csv(path), path_tokens, exclude_name_chars, bad_path)
        is_open = F.coalesce(F.col("__line").rlike(OPEN), F.lit(False))
        if mark:
            df = df.withColumn(UNREADABLE, F.when(is_open, "a cell holds a line break"))
        else:
            broken = F.raise_error(F.concat(F.lit("a cell holds a line break, read with multiline: "), FILE, F.lit(" row "),
                                            F.coalesce(F.col("row_no").cast("string"), "__none", F.lit("?")))).cast("boolean")
            df = df.filter(F.when(is_open, broken).otherwise(F.lit(True)))
    df = df.withColumns({c: F.col(f"`{c}`").cast(t) for c, t in (types or {}).items()})
    return _tagged(df.select("row_no", *[f"`{c}`" for c in columns], FILE, *[c for c in df.columns if c == UNREADABLE]), source, account)


def read_grid(
    spark: SparkSession, path: str | list[str], *, path_tokens: tuple[str, ...] = (),
    exclude_name_chars: str = "(", bad_path: str = "fail", multiline: bool = False, mark: bool = False,
) -> DataFrame:
    """Whole workbook sheets cell by cell: row_no, cells (array of text, as many as the row has), source_file.

    No header is assumed. Empty cells are NULL. multiline: cells may hold line breaks, at the cost of a shuffle of the text.
    Without it, a line that ends within a quoted cell is an error, not a broken row; mark: the row says it in a column __unreadable instead.
    """
    if multiline:
        df = read_records(spark, path, path_tokens=path_tokens, exclude_name_chars=exclude_name_chars, bad_path=bad_path, mark=mark)
    else:
        df = _guarded(spark.read.text(path), path_tokens, exclude_name_chars, bad_path)
        line = F.col("value")
        quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
        broken = F.raise_error(F.concat(F.lit("a cell holds a line break, read with multiline: "), FILE)).cast("string")
        if mark:
            df, broken = df.withColumn(UNREADABLE, F.when(quotes % 2 == 1, "a cell holds a line break")), line
        df = df.withColumn("value", F.when(quotes % 2 == 0, F.rtrim(line, F.lit("\r"))).otherwise(broken))
    cells = _cells(F.col("value"))
    marked = [c for c in df.columns if c == UNREADABLE]
    df = df.filter(F.col("value") != "").select(cells.alias("cells"), FILE, *marked)
    return df.select(F.get("cells", F.lit(0)).try_cast("bigint").alias("row_no"),
                     F.slice("cells", 2, F.greatest(F.size("cells") - 1, F.lit(0))).alias("cells"), FILE, *marked)


def table_from_grid(grid: DataFrame, columns: list[str], *, skip_rows: int = 0, source: str | None = None,
                    account: str | None = None) -> DataFrame:
    """The table under a preamble: skip rows, take the next as header, choose columns by header text.

    The header is one row per file, so files may order their columns differently. A missing column is an error, or,
    where the grid marks its faults, makes the rows of its file unreadable.
    """
    marked = UNREADABLE in grid.columns
    header = grid.filter(F.col("row_no") == skip_rows + 1).select(
        FILE, *[F.array_position("cells", c).alias(f"p{i}") for i, c in enumerate(columns)])
    here = F.col("row_no") > skip_rows + 1
    rows = grid.filter(here | F.col(UNREADABLE).isNotNull() if marked else here).join(header, FILE, "left")
    out, fault = [], F.col(UNREADABLE) if marked else None
    for i, c in enumerate(columns):
        missing = F.raise_error(F.concat(F.lit(f"no column {c!r} in "), FILE)).cast("string")
        at = F.col(f"p{i}").cast("int") - 1
        absent = F.coalesce(at, F.lit(-1)) < 0
        if marked:
            missing, fault = F.lit(None).cast("string"), F.coalesce(fault, F.when(absent, f"no column {c!r}"))
        out.append(F.when(absent, missing).otherwise(F.get("cells", at)).alias(c))
    return _tagged(rows.select("row_no", *out, FILE, *([fault.alias(UNREADABLE)] if marked else [])), source, account)


def with_header_cells(df: DataFrame, grid: DataFrame, cells: dict[str, tuple[int, int]]) -> DataFrame:
    """Add cells of the preamble, (row, column) from 1 and 0, to every row of the same file."""
    rows = sorted({r for r, _ in cells.values()})
    head = grid.filter(F.col("row_no").isin(rows)).groupBy(F.col(FILE).alias("__file")).agg(*[
        F.max(F.when(F.col("row_no") == r, F.get("cells", F.lit(c)))).alias(name) for name, (r, c) in cells.items()])
    return df.join(head, F.col(FILE) == F.col("__file"), "left").drop("__file")


def read_landed_json(spark: SparkSession, path: str | list[str], schema: T.StructType | str, key: str | None = None) -> DataFrame:
    """JSON lines with a declared schema; absent branches are NULL.

    key: the field that names a record. Where pages overlap, the record of the file written last wins, in one
    file the last line; records without a key all stay.
    """
    df = spark.read.schema(schema).json(path)
    if key is None:
        return df
    place = F.struct(F.col("_metadata.file_modification_time"), F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
                     F.monotonically_increasing_id())
    known = df.select(F.struct("*").alias("__row"), place.alias("__place"), F.col(key).alias("__key"))
    last = known.filter("__key is not null").groupBy("__key").agg(F.max_by("__row", "__place").alias("__row"))
    return last.select("__row.*").unionByName(known.filter("__key is null").select("__row.*"))


def explode_path(df: DataFrame, path: str, keep: list[str], alias: str = "item") -> DataFrame:
    """One row per element of a nested list; rows with an empty or missing list vanish."""
    return df.select(*keep, F.explode(path).alias(alias))


def _at(path: str) -> Column:
    """a.b[0].c as a column; an index out of range is NULL."""
    col = None
    for name, index in re.findall(r"([^.\[\]]+)|\[(\d+)\]", path):
        if index:
            col = F.get(col, F.lit(int(index)))
        else:
            col = F.col(f"`{name}`") if col is None else col[name]
    return col


def pick(df: DataFrame, paths: dict[str, str], defaults: dict | None = None) -> DataFrame:
    """Nested paths to flat columns, with a value for what is missing."""
    out = []
    for name, path in paths.items():
        col = _at(path)
        if defaults and name in defaults:
            col = F.coalesce(col, F.lit(defaults[name]))
        out.append(col.alias(name))
    return df.select(*out)


def _time(value) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def time_chunks(spark: SparkSession, start, end, days: int) -> DataFrame:
    """Windows of some days from start to end, the last one cut at the end."""
    step = days * 86_400
    n = F.floor(F.timestamp_diff("SECOND", _time(start), _time(end)) / step).cast("bigint")
    chunks = spark.range(1).select(F.explode(F.sequence(F.lit(0).cast("bigint"), n)).alias("chunk"))
    begin = _time(start) + F.make_dt_interval(secs=(F.col("chunk") * step).cast("decimal(18,6)"))
    last = begin + F.make_dt_interval(secs=F.lit(step - 1))
    return chunks.select("chunk", begin.alias("starts"), F.least(last, _time(end)).alias("ends"))


def assign_chunk(df: DataFrame, ts_col: str, start, days: int) -> DataFrame:
    """The number of the window a time falls into."""
    seconds = F.timestamp_diff("SECOND", _time(start), F.col(ts_col))
    return df.withColumn("chunk", F.floor(seconds / (days * 86_400)).cast("bigint"))
