"""Pages as WARC archives, and the external merge of their capture indexes.

Writing: one record per page through Spark's text writer, whose line separator is the end of a WARC record. Of records with equal
payloads of at least MIN_REVISIT bytes, that with the largest page_id is the response; the others are revisits that refer to it.
Reading: each archive file is parsed by one task along the records' Content-Length; payloads are measured anew, and a revisit's payload is
that of the response it refers to. Files have about FILE_BYTES, which bounds what a task holds.
Merging: the entries of each file, sorted by URL key and time, are a run. Range bounds from a bounded sample of keys deal the runs out;
in each range a loser tree merges the runs' pieces, and the ranges' counts (MAX_RANGES at most) place them in one global order.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from orderloom.llm.tables import staging
from orderloom.staged import staging_root

MIN_REVISIT = 1000
FILE_BYTES = 24 << 20
RANGE_ROWS = 50_000
MAX_RANGES = 20_000
FIRST_CAPTURE = 1_704_067_200  # 2024-01-01T00:00:00Z
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}{CRLF}"
RECORD = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, "
          "url_key string, captured string, file string, offset long, run_no long")


def capture_time(page_id: str = "page_id") -> Column:
    """A time for pages that carry none: a second per page_id."""
    return F.timestamp_seconds(F.coalesce(F.col(page_id), F.lit(0)) + FIRST_CAPTURE)


def with_records(pages: DataFrame, captured: Column | None = None) -> DataFrame:
    """page_id, record: the text of each page's WARC record, without the two line ends that close it."""
    stage = staging(pages.sparkSession)
    html = F.coalesce(F.col("html"), F.lit(""))
    page = pages.select("page_id", "url", html.alias("html"), F.octet_length(html).alias("size"), F.sha1(html.cast("binary")).alias("digest"),
                        (capture_time() if captured is None else captured).alias("captured"))
    large = page.filter(F.col("size") >= MIN_REVISIT).groupBy("digest", "size").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
    copied = stage(large.filter("n > 1 and refers_to is not null").drop("n"))  # read back, its size is known: small ones are broadcast
    page = page.join(copied, ["digest", "size"], "left")
    revisit = F.col("refers_to").isNotNull() & F.col("page_id").isNotNull() & (F.col("page_id") != F.col("refers_to"))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    url = F.regexp_replace(F.regexp_replace(F.col("url"), "\r", "%0D"), "\n", "%0A")
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">"))
    body = F.when(revisit, F.lit(HTTP)).otherwise(F.concat(F.lit(HTTP), F.col("html")))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))), line("WARC-Record-ID", name),
        line("WARC-Date", F.date_format(F.to_utc_timestamp("captured", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">")))))
        .otherwise(F.lit("")),
        F.lit(f"Content-Type: application/http;msgtype=response{CRLF}"), line("Content-Length", F.octet_length(body).cast("string")), F.lit(CRLF))
    return page.select("page_id", F.concat(head, body).alias("record"))


def write_archives(pages: DataFrame, path: str, captured: Column | None = None) -> None:
    """The records of all pages as .warc files of about FILE_BYTES each below `path`."""
    mean = pages.agg(F.avg(F.coalesce(F.octet_length("html"), F.lit(0)) + 600)).first()[0] or FILE_BYTES
    with_records(pages, captured).select("record").write.option("lineSep", CRLF * 2).option("maxRecordsPerFile", max(1, int(FILE_BYTES / mean))).text(path)


def url_key(url: str | None) -> str:
    """The URL in sort-friendly form: reversed host, path and query in lower-case scheme-free form, without www, default port and fragment."""
    if url is None:
        return ""
    m = re.match(r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^#]*)", url)
    if not m:
        return url
    host = re.sub(r"^www\.", "", re.sub(r":(80|443)$", "", m[1].rpartition("@")[2].lower()))
    rest = m[2] if m[2].startswith("/") else "/" + m[2]
    return f"{','.join(reversed(host.split('.')))}){rest}"


def _page(name: str | None) -> int | None:
    digits = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits.removeprefix("-").isdigit() else None


def parse(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, payload) of each record of an archive. Ill-formed archives raise ValueError."""
    at = 0
    while at < len(content):
        end = content.find(b"\r\n\r\n", at)
        lines = content[at:end].decode().split(CRLF)
        if end < 0 or not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        start, size = end + 4, int(headers["Content-Length"])
        if content[start + size: start + size + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where its length says")
        block = content[start: start + size]
        yield at, headers, block[block.find(b"\r\n\r\n") + 4:]
        at = start + size + 4


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per record of the archives below `path`, each file a run sorted by url_key, captured, page_id (run_no counts up)."""
    def run(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            for file, content in zip(batch.column("path"), batch.column("content")):
                name, rows = file.as_py(), []
                for offset, headers, payload in parse(content.as_buffer().to_pybytes()):
                    stated = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind, refers, size = headers["WARC-Type"], _page(headers.get("WARC-Refers-To")), None
                    if kind == "response":
                        size = len(payload)
                        if hashlib.sha1(payload).hexdigest() != stated:
                            raise ValueError(f"{name}: the payload at byte {offset} has another digest than its header")
                    url = headers.get("WARC-Target-URI")
                    rows.append({"page_id": _page(headers["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": stated, "record_type": kind, "refers_to": refers,
                                 "url": url, "url_key": url_key(url), "captured": headers["WARC-Date"], "file": name, "offset": offset})
                rows.sort(key=_order)
                for i, r in enumerate(rows):
                    r["run_no"] = i
                for i in range(0, len(rows), 5000):
                    yield pa.RecordBatch.from_pylist(rows[i: i + 5000], schema=schema)

    schema = pa.schema([(n, pa.int64() if t == "long" else pa.string()) for n, t in (c.split() for c in RECORD.split(", "))])
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content").mapInArrow(run, RECORD)


def _order(row: dict) -> tuple:
    return row["url_key"], row["captured"], row["page_id"] is not None, row["page_id"] or 0, row["file"], row["offset"]


class LoserTree:
    """The items of sorted runs in order. Each inner node holds the loser of the match below it, so an item costs one match per level."""

    def __init__(self, runs: list[Iterable]):
        self.runs = [iter(r) for r in runs]
        self.k = len(self.runs)
        self.heads = [next(r, None) for r in self.runs]
        self.losers = [-1] * max(1, self.k)
        for leaf in range(self.k):
            self._play(leaf)

    def _less(self, a: int, b: int) -> bool:
        if self.heads[a] is None or self.heads[b] is None:
            return self.heads[b] is None and (self.heads[a] is not None or a < b)
        return (self.heads[a], a) < (self.heads[b], b)

    def _play(self, leaf: int) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            other = self.losers[node]
            if other < 0:  # the first to come waits for its opponent
                self.losers[node] = winner
                return
            if self._less(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator:
        while self.k:
            winner = self.losers[0]
            item = self.heads[winner]
            if item is None:
                return
            yield item
            self.heads[winner] = next(self.runs[winner], None)
            self._play(winner)


def merge_runs(records: DataFrame, *, range_rows: int = RANGE_ROWS, max_ranges: int = MAX_RANGES) -> DataFrame:
    """The records with history_rank: their place, from 0, in the order of url_key, captured, page_id (null first), file and offset."""
    total = records.count()
    ranges = min(max_ranges, max(1, -(-total // range_rows)))
    key = ["url_key", "captured", "page_id", "file", "offset"]
    sample = records.select(*key).orderBy(F.xxhash64("file", "offset")).limit(8 * ranges if ranges > 1 else 0).collect()  # 8 * MAX_RANGES keys at most
    sample = sorted(_order(r.asDict()) for r in sample)
    bounds = sample[8::8]

    def deal(batches):
        for batch in batches:
            rows = [_order(r) for r in batch.select(key).to_pylist()]
            yield batch.append_column("range_", pa.array([bisect.bisect_right(bounds, r) for r in rows], pa.int32()))

    def merge(table: pa.Table) -> pa.Table:
        runs: dict[str, list] = {}
        rows = table.to_pylist()
        for i, r in enumerate(rows):
            runs.setdefault(r["file"], []).append((r["run_no"], i))
        pieces = [[(_order(rows[i]), i) for _, i in sorted(run)] for _, run in sorted(runs.items())]
        order = [i for _, i in LoserTree(pieces)]
        return table.take(pa.array(order, pa.int64())).append_column("place_", pa.array(range(len(order)), pa.int64()))

    stage = staging(records.sparkSession)
    merged = stage(records.mapInArrow(deal, f"{RECORD}, range_ int").groupBy("range_").applyInArrow(merge, f"{RECORD}, range_ int, place_ long"))
    counts = merged.groupBy("range_").agg(F.count("*").alias("n_"))  # a row per range
    before = F.coalesce(F.sum("n_").over(Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return merged.join(F.broadcast(counts.select("range_", before.alias("before_"))), "range_").withColumn(
        "history_rank", F.col("before_") + F.col("place_")).drop("range_", "place_", "before_", "run_no")


def archive_roundtrip(pages: DataFrame, captured: Column | None = None, path: str | None = None) -> DataFrame:
    """Writes the pages (page_id, url, html) as archives, reads them back and merges their indexes: a row per page with page_id,
    payload_bytes, payload_digest (both of the full payload), record_type, refers_to, url, url_key, captured, file, offset, history_rank.

    A null html is an empty payload; a null url leaves out the record's URI and gives an empty url_key; records with a null page_id are
    responses. Repeated rows with the largest page_id of a payload are all responses. An empty table gives an empty result.
    """
    spark = pages.sparkSession
    stage = staging(spark)
    if path is None:
        path = f"{staging_root(spark)}/warc-{stage.root.rpartition('/')[2]}"
    write_archives(pages, path, captured)
    records = stage(read_archives(spark, path))
    full = records.filter("record_type = 'response' and payload_bytes >= 0 and page_id is not null").groupBy(
        F.col("page_id").alias("target_"), F.col("payload_digest").alias("digest_")).agg(F.max("payload_bytes").alias("bytes_"))
    merged = merge_runs(records)
    revisits = merged.filter("record_type = 'revisit'").join(full, (F.col("refers_to") == F.col("target_")) & (F.col("payload_digest") == F.col("digest_")), "left").withColumn(
        "payload_bytes", F.col("bytes_")).select(*merged.columns)
    return merged.filter("record_type <> 'revisit'").unionByName(revisits)
