"""Tables kept as Parquet partitions, months of the date their rows carry.

A merge looks up which partitions hold one of its keys, by a scan of the key columns alone, merges these and the months its own rows belong to, and
writes them with Spark's dynamic partition overwrite: what a batch does not touch is not read beyond its keys and not written. The partition is a
matter of layout only: rows are always found by key, whichever month they lie in. A row whose date changes moves to its new month if the batch says
the date. One job writes a table at a time. Where
a catalog offers a table format with MERGE, use that instead: it also survives a driver that dies while Spark moves finished partitions into place.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators.relational import keep_keys, lookup
from orderloom.schemas import LAKE, LAKE_KEYS, STAR, STAR_KEYS
from orderloom.staged import Staged

KEYS = {**LAKE_KEYS, **STAR_KEYS}
SCHEMAS = {**LAKE, **STAR}
PART = "part"
UNKNOWN = "unknown"
MARKS = "name STRING, mark TIMESTAMP_NTZ"

# The date whose month a row lies in.
DATE_OF = {
    "nhanhvnorders": "created_at", "shopeeorders": "createdat", "tiktokorders": "create_time", "deliveryorders": "createdat",
    "customerbanks": "notedate", "returnedorders_scan": "scanat", "delivery_reconciliation": "reconciliation_at",
    "handle_deliveryorders": "scan_deliveryorder_at", "tiktok_reconciliation": "transactiontime",
    "dim_order": "createdat", "dim_delivery": "createdat", "dim_reconciliation": "min_transactiontime",
}
# Lines have no date of their own and lie with their order. Other tables lie in ranges of their key's hash.
HEADER_OF = {
    "nhanhvnorderdetails": "nhanhvnorders", "shopeeorderdetails": "shopeeorders", "tiktokorderdetails": "tiktokorders",
    "fact_orderdetails": "dim_order",
}

Merge = Callable[[DataFrame, DataFrame], DataFrame]


class TableStore:
    """All tables under one root folder on storage that every executor shares."""

    def __init__(self, spark: SparkSession, root: str, parts: int = 64, grain: str = "yyyy-MM"):
        """parts: partitions of a table without a date. grain: what of a date names a partition, months or days ("yyyy-MM-dd")."""
        self.spark, self.root, self.parts, self.grain = spark, root.rstrip("/"), parts, grain
        self.written: dict[str, list[str]] = {}  # partitions the last write of each table wrote or emptied

    def _at(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self, path: str):
        return self._at(path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _there(self, path: str) -> bool:
        return self._files(path).exists(self._at(path))

    def there(self, name: str) -> bool:
        return self._there(self.path(name))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _month(self, name: str) -> Column:
        return F.coalesce(F.date_format(DATE_OF[name], self.grain), F.lit(UNKNOWN))

    def placed(self, name: str, df: DataFrame) -> DataFrame:
        """The rows with the partition they belong to."""
        if name in DATE_OF:
            return df.withColumn(PART, self._month(name))
        if name in HEADER_OF:
            header = HEADER_OF[name]
            # narrow: ids and months of the orders
            found = lookup(df, self.read(header, with_part=True).select("orderid", PART), "orderid", [PART])
            return found.withColumn(PART, F.coalesce(PART, F.lit(UNKNOWN)))
        return df.withColumn(PART, F.concat(F.lit("h"), F.pmod(F.xxhash64(*KEYS[name]), F.lit(self.parts))))

    def read(self, name: str, parts: list[str] | None = None, with_part: bool = False) -> DataFrame:
        """The current rows, of some partitions only if given."""
        schema = T.StructType([*SCHEMAS[name].fields, T.StructField(PART, T.StringType())])
        if self._there(self.path(name)):
            df = self.spark.read.schema(schema).parquet(self.path(name))
        else:  # a table that was never written is empty
            df = self.spark.createDataFrame([], schema)
        if parts is not None:
            df = df.filter(F.col(PART).isin(parts) if parts else F.lit(False))
        return df if with_part else df.drop(PART)

    def _holding(self, name: str, keys: DataFrame, on) -> DataFrame:
        """The partitions that hold one of the keys; reads nothing but the key columns."""
        pairs = on if isinstance(on, dict) else {k: k for k in ([on] if isinstance(on, str) else on)}
        return keep_keys(self.read(name, with_part=True).select(*pairs, PART), keys, pairs).select(PART).distinct()

    def parts_of(self, name: str, keys: DataFrame, on) -> list[str]:
        """The names of the partitions that hold one of the keys: at most one short text per partition."""
        return sorted(r[0] for r in self._holding(name, keys, on).collect())

    def reach(self, name: str, keys: DataFrame, on) -> DataFrame:
        """The rows with one of the keys (on: columns of the table, or a dict from them to those of `keys`), from the partitions that hold some."""
        return keep_keys(self.read(name, self.parts_of(name, keys, on)), keys, on)

    def _write(self, name: str, df: DataFrame, touched: set[str], only: bool = False) -> None:
        """only: rows stay within the touched partitions; one that belongs to another, which was not read, lies in the first of them instead."""
        schema = SCHEMAS[name]
        rows = self.placed(name, df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]))
        if only:
            rows = rows.withColumn(PART, F.when(F.col(PART).isin(sorted(touched)), F.col(PART)).otherwise(F.lit(min(touched))))
        stamp = next((c for c in ("dw_updatedat", "lastupdateat") if c in schema.names), None)
        seen = Observation()
        rows = rows.observe(seen, F.max(stamp or F.lit(None).cast("timestamp_ntz")).alias("mark"))
        self.overwrite_parts(name, self.path(name), rows, touched)
        if seen.get["mark"] is not None:
            one = self.spark.createDataFrame([(name, seen.get["mark"])], MARKS)
            one.coalesce(1).write.mode("append").parquet(self.path("_marks"))

    def overwrite_parts(self, name: str, path: str, rows: DataFrame, touched: set[str] | None) -> list[str]:
        """Write rows over the partitions they lie in, and drop the touched ones (None: all there are) that none lies in any more."""
        if touched is None:
            there = self.spark.read.parquet(path).select(PART).distinct().collect() if self._there(path) else []
            touched = {r[0] for r in there}
        seen = Observation()
        rows = rows.hint("rebalance", PART)  # adaptive execution splits large months over tasks and joins small ones before writing
        rows = rows.observe(seen, F.collect_set(PART).alias("parts"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)
        written = set(seen.get["parts"] or [])
        for part in touched - written:  # rows left that no other took the place of
            self._files(path).delete(self._at(f"{path}/{PART}={part}"), True)
        self.written[name] = sorted(touched | written)
        return self.written[name]

    def marks(self) -> dict[str, datetime]:
        """The highest stamp ever written per table, from what each write observed: a short row per write, and none of the tables is read."""
        if not self._there(self.path("_marks")):
            return {}
        seen = self.spark.read.schema(MARKS).parquet(self.path("_marks"))
        return {r.name: r.mark for r in seen.groupBy("name").agg(F.max("mark").alias("mark")).collect()}

    def replace(self, name: str, df: DataFrame) -> DataFrame:
        """Write a whole table."""
        old = {r[0] for r in self.read(name, with_part=True).select(PART).distinct().collect()}
        self._write(name, df, old)
        return self.read(name)

    def merge(self, name: str, source: DataFrame, merge: Merge, staged: Staged | None = None) -> DataFrame:
        """Apply merge(target rows, source rows) to the partitions that hold a key of the source or get one of its rows; give the new table.

        `merge` gets, and may change or drop, all rows of these partitions. The source is read several times: pass a Staged to have it
        written once first, unless it is a stored table already. It holds the key columns, or for a delete those of its `on`.
        """
        if staged is not None:
            source = staged(source)
        keys = [k for k in KEYS[name] if k in source.columns]
        holding, own = self._holding(name, source, keys), self._own_parts(name, source)
        touched = {r[0] for r in (holding if own is None else holding.union(own)).distinct().collect()}  # one short text per partition
        if own is None and not touched and not source.isEmpty():
            touched = {UNKNOWN}
        if touched:
            self._write(name, merge(self.read(name, sorted(touched)), source), touched, only=True)
        return self.read(name)

    def _own_parts(self, name: str, source: DataFrame) -> DataFrame | None:
        """Partitions that the rows of a batch belong to, if the batch says (a folded batch has the date in one of its structs)."""
        if name in DATE_OF:
            date = DATE_OF[name]
            held = [F.col(date)] if date in source.columns else [
                F.col(f.name)[date] for f in source.schema.fields if isinstance(f.dataType, T.StructType) and date in f.dataType.names]
            return source.select(F.coalesce(F.date_format(held[0], self.grain), F.lit(UNKNOWN)).alias(PART)) if held else None
        return self.placed(name, source).select(PART) if set(KEYS[name]) <= set(source.columns) else None
