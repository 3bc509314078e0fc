"""Cleaning of text, ids, amounts, dates and nested cells."""

from datetime import date

from pyspark.sql import functions as F

from orderloom.functions import scalar as s
from orderloom.operators import quality
from orderloom.operators.relational import lookup
from orderloom.plans.registry import cents, query
from orderloom.sources.landed import assign_chunk, pick, time_chunks


@query(r"""
WITH folded AS (SELECT doc_id, regexp_replace(lower(replace(strip_accents(replace(replace(text, 'đ', 'd'), 'ß', 'ss')), '—', '--')),
    '[\n\t ]', ' ', 'g') AS note FROM documents)
SELECT doc_id, length(note) AS n_letters, md5(note) AS note_hash,
  CASE WHEN length(note) > 255 THEN substr(note, 1, 254) ELSE note END AS note,
  regexp_matches(note, '(?i)the|und') AS has_word, note LIKE 'the%' AS starts_the, note LIKE '%.' AS ends_dot,
  regexp_replace(regexp_replace(trim(note), '[ +-]', ',', 'g'), ',+', ',', 'g') LIKE '%,a,%' AS lists_a
FROM folded
""")
def clean_notes(t):
    note = F.regexp_replace(F.lower(s.fold_diacritics(F.col("text"))), r"[\n\t ]", " ")
    rows = t.documents.select("doc_id", note.alias("note"))
    full = F.col("note")
    return rows.select(
        "doc_id", F.length(full).alias("n_letters"), F.md5(full).alias("note_hash"),
        s.truncate_to(full, 255).alias("note"),
        s.matches(full, "the|und", ignore_case=True).alias("has_word"),
        full.startswith("the").alias("starts_the"), full.endswith(".").alias("ends_dot"),
        s.comma_list(full).contains(",a,").alias("lists_a"))


@query(r"""
WITH sku AS (SELECT p_partkey, upper(p_type || '-' || replace(p_brand, '#', '_') || '-' || p_size) AS sku,
  lpad(cast(p_partkey AS varchar), 13, 'x') AS code FROM part)
SELECT p_partkey, sku, split_part(sku, '-', 1) AS parent, split_part(sku, '_', 1) AS before_mark,
  regexp_replace(sku, '-[^-]*$', '') AS head, split_part(sku, '-', 2) AS middle, right(code, 10) AS last10,
  substr(code, 1, length(code) - 3) AS cut3,
  CASE WHEN sku LIKE '%-50' AND length(sku) = 17 THEN substr(sku, 1, length(sku) - 3) ELSE sku END AS trimmed,
  regexp_matches(right(code, 10), '[A-Za-z]') AS has_letter
FROM sku
""")
def sku_prefix(t):
    sku = F.upper(F.concat_ws("-", "p_type", F.replace(F.col("p_brand"), F.lit("#"), F.lit("_")), "p_size"))
    rows = t.part.select("p_partkey", sku.alias("sku"), F.lpad(F.col("p_partkey").cast("string"), 13, "x").alias("code"))
    sku, code = F.col("sku"), F.col("code")
    return rows.select(
        "p_partkey", "sku", s.sku_prefix(sku).alias("parent"), s.sku_prefix(sku, "_").alias("before_mark"),
        s.head_before_last(sku).alias("head"), F.split_part(sku, F.lit("-"), F.lit(2)).alias("middle"),
        s.last_chars(code, 10).alias("last10"), s.drop_last(code, 3).alias("cut3"),
        s.drop_suffix(sku, "-50", 17).alias("trimmed"),
        s.matches(s.last_chars(code, 10), "[A-Za-z]").alias("has_letter"))


@query(r"""
SELECT 'page' AS kind, page_id AS id, nullif(regexp_extract(url, '/(\d+)', 1), '') AS number,
  nullif(regexp_extract(html, '(\d+)(?:px)', 1), '') AS size, regexp_matches(url, '(?i)REF\s*=\s*[a-z]') AS has_ref
FROM pages
UNION ALL
SELECT 'document', doc_id, nullif(regexp_extract(text, '(?:^|[^0-9A-Za-z])(\d{4,16})(?:[^0-9A-Za-z]|$)', 1), ''),
  nullif(regexp_extract(text, '(\d+)(?:k)', 1), ''), regexp_matches(text, '(?i)MIT\s*license') FROM documents
""")
def extract_ids(t):
    pages = t.pages.select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), s.extract(F.col("url"), r"/(\d+)").alias("number"),
        s.extract(F.col("html"), r"(\d+)(?=px)").alias("size"),
        s.matches(F.col("url"), r"REF\s*=\s*[a-z]", ignore_case=True).alias("has_ref"))
    notes = t.documents.select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"),
        s.extract(F.col("text"), r"(?:^|[^0-9A-Za-z])(\d{4,16})(?:[^0-9A-Za-z]|$)").alias("number"),
        s.extract(F.col("text"), r"(\d+)(?=k)").alias("size"),
        s.matches(F.col("text"), r"MIT\s*license", ignore_case=True).alias("has_ref"))
    return pages.unionByName(notes)


@query("""
WITH cell AS (SELECT event_id, cast(round(value * 100) AS bigint) AS exact, event_type FROM events)
SELECT event_id, exact AS strict_amount,
  CASE WHEN event_type = 'error' THEN NULL ELSE exact END AS lenient_amount,
  CASE WHEN event_type = 'error' THEN 0 ELSE exact END AS coerced_amount,
  exact * 1000 AS thousands, nullif(exact, 655) AS without_655
FROM cell
""")
def parse_amounts(t):
    exact = cents("value")
    rows = t.events.select(
        "event_id", "event_type",
        F.concat(F.lit(" "), F.regexp_replace(exact.cast("string"), r"(\d)(?=(\d{3})+$)", "$1."), F.lit(" đ")).alias("cell"),
        F.concat(exact.cast("string"), F.lit("K\nlẻ")).alias("note"))
    lenient = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(s.drop_currency(F.col("cell")))
    return rows.select(
        "event_id", s.money(F.col("cell")).alias("strict_amount"), s.whole_number(lenient).alias("lenient_amount"),
        quality.coerce(lenient).alias("coerced_amount"), s.thousands(F.col("note")).alias("thousands"),
        s.null_if(s.money(F.col("cell")), 655).alias("without_655"))


@query("""
WITH bad AS (SELECT o_orderpriority, max(CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' THEN 1 ELSE 0 END)
    AS bad FROM orders GROUP BY o_orderpriority)
SELECT o_orderkey, CASE WHEN bad = 1 THEN DATE '2026-01-31' ELSE cast(o_orderdate AS date) END AS paid_on,
  cast(o_orderdate AS date) + 1 AS next_day, make_date(2026, month(o_orderdate), 1) AS month_start,
  strftime(o_orderdate, '%Y-%m-%d') AS as_text
FROM orders JOIN bad USING (o_orderpriority)
""")
def parse_dates(t):
    at = F.col("o_orderdate")
    torn = (F.col("o_orderpriority") == "3-MEDIUM") & (F.col("o_orderstatus") == "P")
    cells = t.orders.select(
        "o_orderkey", F.col("o_orderpriority").alias("source_file"),
        F.when(torn, F.lit("phien loi")).otherwise(F.date_format(at, "dd/MM/yyyy")).alias("cell"),
        F.date_format(at, "yyyy/MM/dd HH:mm:ss").alias("full"), F.date_format(at, "MM").alias("month"))
    parsed = s.parse_date(F.col("cell"), "dd/MM/yyyy")
    rows = cells.withColumn("paid_on", parsed)
    rows = quality.fallback_per_file(rows, "paid_on", F.col("paid_on").isNull(), F.lit(date(2026, 1, 31)))
    full = s.parse_time_strict(F.col("full"), "yyyy/MM/dd HH:mm:ss")
    return rows.select(
        "o_orderkey", "paid_on", F.date_add(full.cast("date"), 1).alias("next_day"),
        s.parse_date(F.concat(F.lit("2026-"), "month", F.lit("-01")), "yyyy-MM-dd").alias("month_start"),
        F.date_format(full, "yyyy-MM-dd").alias("as_text"))


@query("""
SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) + INTERVAL 7 HOUR END AS local_at,
  epoch_us(ts) // 1000000 - 7 * 3600 AS unix_seconds, strftime(ts, '%Y-%m-%d') AS day
FROM events
""")
def epoch_to_local(t):
    raw = F.when(F.col("event_type") != "error", F.timestamp_diff("SECOND", F.expr(s.EPOCH), F.col("ts"))).otherwise(0)
    return t.events.select(
        "event_id", s.local_time(s.null_if(raw, 0)).alias("local_at"), s.epoch_seconds(F.col("ts")).alias("unix_seconds"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"))


@query("""
SELECT event_id, cast(json_extract_string(props, '$.k') AS bigint) AS k, CAST(NULL AS bigint) AS amount,
  0 AS deposit, CAST(NULL AS VARCHAR) AS first_address, CAST(NULL AS VARCHAR) AS returns
FROM events
""")
def json_paths(t):
    schema = ("k BIGINT, payment STRUCT<transfer: STRUCT<amount: BIGINT>>, "
              "address STRUCT<levels: ARRAY<STRUCT<name: STRING>>>, returns ARRAY<STRING>")
    rows = t.events.select("event_id", F.from_json("props", schema).alias("doc"))
    out = pick(rows, {"event_id": "event_id", "k": "doc.k", "amount": "doc.payment.transfer.amount",
                      "deposit": "doc.payment.transfer.amount", "first_address": "doc.address.levels[0].name",
                      "returns": "doc.returns"}, defaults={"deposit": 0})
    return out.withColumn("returns", s.list_text(F.col("returns")))


@query("""
WITH chunk AS (SELECT n AS chunk, TIMESTAMP '2024-01-01' + to_seconds(n * 13 * 86400) AS starts,
  least(TIMESTAMP '2024-01-01' + to_seconds((n + 1) * 13 * 86400 - 1), TIMESTAMP '2024-01-30 23:59:59') AS ends
  FROM (SELECT unnest(generate_series(0, 2)) AS n)),
hit AS (SELECT (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 1000000 // (13 * 86400) AS chunk, count(*) AS n,
  cast(sum(round(value * 100)) AS bigint) AS amount FROM events GROUP BY 1)
SELECT chunk.chunk, starts, ends, coalesce(n, 0) AS n, coalesce(amount, 0) AS amount
FROM chunk LEFT JOIN hit ON chunk.chunk = hit.chunk
""")
def time_chunk_totals(t):
    chunks = time_chunks(t.spark, "2024-01-01 00:00:00", "2024-01-30 23:59:59", 13)
    hits = assign_chunk(t.events, "ts", "2024-01-01 00:00:00", 13).groupBy("chunk").agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents("value")).alias("amount"))
    out = lookup(chunks, hits, "chunk", ["n", "amount"])
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n", "amount")})
