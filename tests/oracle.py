"""Compare registered queries with their SQL in DuckDB on the same tables."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

TESTDATA = os.environ.get("ORDERLOOM_TESTDATA", "/root/testdata")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return float(f"{value:.12g}")
    if hasattr(value, "normalize") and hasattr(value, "as_tuple"):
        return float(value)
    if hasattr(value, "isoformat"):
        return value.isoformat(" ") if hasattr(value, "hour") else value.isoformat()
    if isinstance(value, int) and not isinstance(value, bool):
        return value
    return value


def compare(spark, fn, sql: str, sf_dir: str, con) -> tuple[bool, str]:
    df = fn(spark, sf_dir)
    cols = sorted(df.columns)
    got = Counter(tuple(_cell(v) for v in row) for row in df.select(*[f"`{c}`" for c in cols]).collect())
    rel = con.sql(sql)
    if sorted(rel.columns) != cols:
        return False, f"columns {cols} != {sorted(rel.columns)}"
    picked = ", ".join(f'"{c}"' for c in cols)
    want = Counter(tuple(_cell(v) for v in row) for row in con.execute(f"SELECT {picked} FROM ({sql})").fetchall())
    if got == want:
        return True, f"{sum(got.values())} rows"
    only_spark, only_sql = got - want, want - got
    return False, (f"{sum(got.values())} vs {sum(want.values())} rows; spark only {list(only_spark.items())[:3]}; "
                   f"sql only {list(only_sql.items())[:3]}; cols {cols}")


def main(names: list[str], sf: str = "sf0.01") -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from orderloom.session import local_session

    spark = local_session("oracle", 8, **{"spark.sql.shuffle.partitions": "8"})
    sf_dir = f"{TESTDATA}/{sf}"
    con, bad = duck(sf_dir), 0
    sqls = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in sqls:
                ok, text = compare(spark, fn, sqls[name], sf_dir, con)
            else:
                ok, text = True, f"no SQL, {fn(spark, sf_dir).count()} rows"
        except Exception as error:  # report and go on with the next query
            ok, text = False, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {text}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    args = [a for a in sys.argv[1:] if not a.startswith("sf")]
    sfs = [a for a in sys.argv[1:] if a.startswith("sf")] or ["sf0.01"]
    sys.exit(sum(main(args, sf) for sf in sfs))
