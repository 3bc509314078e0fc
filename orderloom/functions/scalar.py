"""Column helpers for text, ids, money and times (F1-F32). All are built-in expressions:
nothing here leaves whole-stage code generation for a Python worker."""

from __future__ import annotations

import unicodedata
from functools import cache, reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "Asia/Ho_Chi_Minh"

# Letters without a canonical decomposition, and their ASCII form.
SINGLE_FOLDS = {
    "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "ı": "i",
    "‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "\u00a0": " ",
}
MULTI_FOLDS = {
    "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "Th",
    "…": "...", "—": "--", "€": "EUR",
}


@cache
def _fold_table() -> tuple[str, str]:
    pairs = dict(SINGLE_FOLDS)
    for code in (*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)):
        letter = chr(code)
        base = unicodedata.normalize("NFD", letter)[0]
        if base != letter and base.isascii():
            pairs[letter] = base
    return "".join(pairs), "".join(pairs.values())


def fold_diacritics(col: Column) -> Column:
    """ASCII form of accented Latin text; NULL stays NULL.

    Plain ASCII text is passed through after one look, and the folds to several letters run only on texts
    that hold such a letter.
    """
    plain, folded = _fold_table()
    out = F.translate(F.regexp_replace(col, r"\p{Mn}+", ""), plain, folded)
    wide = out
    for letter, text in MULTI_FOLDS.items():
        wide = F.replace(wide, F.lit(letter), F.lit(text))
    out = F.when(col.rlike("[" + "".join(MULTI_FOLDS) + "]"), wide).otherwise(out)
    return F.when(col.rlike(r"[^\x00-\x7F]"), out).otherwise(col)


WHITE_SPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\u00a0\u2028\u2029\u3000"


def strip_ws(col: Column) -> Column:
    """Cut all white space at both ends, not only blanks."""
    return F.btrim(col, F.lit(WHITE_SPACE))


def drop_ws(col: Column) -> Column:
    """Remove blanks, tabs and line breaks anywhere."""
    return F.regexp_replace(col, r"[\n\t ]", "")


def drop_currency(col: Column, extra: str = "") -> Column:
    """Remove white space, the thousands dot, the dong sign and any extra characters."""
    return F.regexp_replace(col, rf"[\n\t .đ{extra}]", "")


def null_if(col: Column, *values) -> Column:
    return reduce(lambda c, v: F.nullif(c, F.lit(v)), values, col)


def null_if_blank(col: Column) -> Column:
    return null_if(col, "")


def zero_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def comma_list(col: Column) -> Column:
    """Ids split by blanks, tabs, line breaks, plus or minus, joined by single commas."""
    return F.regexp_replace(strip_ws(col), r"[\n\t +,-]+", ",")


def sku_prefix(col: Column, sep: str = "-") -> Column:
    """Text before the first separator, or all of it where there is none."""
    return F.substring_index(col, sep, 1)


def head_before_last(col: Column, sep: str = "-") -> Column:
    """Text before the last separator, or all of it where there is none."""
    return F.regexp_replace(col, rf"\Q{sep}\E[^{sep}]*$", "")


def last_chars(col: Column, n: int) -> Column:
    return F.right(col, F.lit(n))


def drop_last(col: Column, n: int) -> Column:
    return F.substring(col, F.lit(1), F.greatest(F.length(col) - n, F.lit(0)))


def drop_suffix(col: Column, suffix: str, length: int | None = None) -> Column:
    """Cut a suffix, optionally only from texts of one length."""
    hit = col.endswith(suffix)
    if length is not None:
        hit = hit & (F.length(col) == length)
    return F.when(hit, drop_last(col, len(suffix))).otherwise(col)


def truncate_to(col: Column, limit: int) -> Column:
    """Texts longer than the limit keep one character less than it."""
    return F.when(F.length(col) > limit, F.left(col, F.lit(limit - 1))).otherwise(col)


def extract(col: Column, pattern: str, group: int = 1) -> Column:
    """First match of a pattern, NULL where there is none."""
    return F.nullif(F.regexp_extract(col, pattern, group), F.lit(""))


def matches(col: Column, pattern: str, *, ignore_case: bool = False) -> Column:
    """Whether the pattern is found; NULL counts as no match."""
    return F.coalesce(col.rlike(f"(?i){pattern}" if ignore_case else pattern), F.lit(False))


def whole_number(col: Column) -> Column:
    """Lenient number: NULL for what is not one."""
    return col.try_cast("bigint")


def money(col: Column, extra: str = "") -> Column:
    """Whole dong from a formatted cell; blank is NULL, other text fails the query."""
    return null_if_blank(drop_currency(col, extra)).cast("bigint")


def thousands(col: Column) -> Column:
    """Price notes such as 350k: the digits before the first k, times 1000."""
    text = F.lower(fold_diacritics(drop_ws(col)))
    return extract(text, r"(\d+)(?=k)").cast("bigint") * 1000


def parse_time(col: Column, fmt: str) -> Column:
    """Lenient time by pattern, without time zone."""
    return F.try_to_timestamp(col, F.lit(fmt)).cast("timestamp_ntz")


def parse_time_strict(col: Column, fmt: str) -> Column:
    """As parse_time; text that does not fit the pattern fails the query."""
    parsed = parse_time(col, fmt)
    return F.when(
        col.isNotNull() & parsed.isNull(),
        F.raise_error(F.concat(F.lit("not a time of pattern " + fmt + ": "), col)).cast("timestamp_ntz"),
    ).otherwise(parsed)


def parse_date(col: Column, fmt: str) -> Column:
    return parse_time(col, fmt).cast("date")


EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def local_time(epoch_seconds: Column, zone: str = LOCAL_ZONE) -> Column:
    """Unix seconds to naive local time, whatever the session time zone is."""
    utc = F.expr(EPOCH) + F.make_dt_interval(secs=epoch_seconds.cast("decimal(18,6)"))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def epoch_seconds(local: Column, zone: str = LOCAL_ZONE) -> Column:
    """Naive local time to unix seconds."""
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), local)
    return F.timestamp_diff("SECOND", F.expr(EPOCH), utc)


def safe_ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 where whole is 0, NULL where either is NULL."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / whole.cast("double"))


def sum_columns(cols: list[Column], sign: int = 1) -> Column:
    """Sum across columns, NULL counted as 0."""
    return reduce(add, [zero_if_null(c) for c in cols]) * sign


def sum_array(array: Column, field: str) -> Column:
    """Sum of a text field inside an array of structs; NULL as soon as one is not a whole number."""
    return F.aggregate(array, F.lit(0).cast("bigint"), lambda total, item: total + item[field].try_cast("bigint"))


def list_text(array: Column, sep: str = ",") -> Column:
    """Array as delimited text; an empty or missing array is NULL."""
    return F.when(F.size(array) > 0, F.array_join(array, sep))


def surrogate(*cols: Column) -> Column:
    """Key of several parts, missing parts as empty text."""
    return F.concat_ws("_", *[F.coalesce(c, F.lit("")) for c in cols])
