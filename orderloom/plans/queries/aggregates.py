"""Grouped totals, ordered text, shares, and row-order operators."""

from pyspark.sql import functions as F

from orderloom.functions.scalar import safe_ratio, sku_prefix, sum_array, sum_columns
from orderloom.operators import aggregates as agg, relational as rel, windows as win
from orderloom.plans.registry import cents, query, whole


@query("""
WITH cash AS (SELECT user_id, cast(round(value * 100) AS bigint) AS amount, ts,
  'acct-' || strftime(ts, '%Y%m%d') || '-' || strftime(ts, '%m%d') AS session FROM events WHERE event_type <> 'view')
SELECT user_id, session, cast(sum(amount) AS bigint) AS amount, min(ts) AS first_at,
  cast(strptime(substr(split_part(session, '-', 2), 1, 4) || '-' || substr(split_part(session, '-', 3), 1, 2) || '-'
       || substr(split_part(session, '-', 3), 3), '%Y-%m-%d') AS date) + 1 AS paid_on
FROM cash GROUP BY user_id, session
""")
def cash_session_totals(t):
    cash = t.events.filter("event_type <> 'view'").select(
        "user_id", "ts", cents("value").alias("amount"),
        F.concat(F.lit("acct-"), F.date_format("ts", "yyyyMMdd"), F.lit("-"), F.date_format("ts", "MMdd")).alias("session"))
    out = agg.totals(cash, ["user_id", "session"], sums={"amount": F.col("amount")}, mins={"first_at": F.col("ts")})
    year, day = F.split_part("session", F.lit("-"), F.lit(2)), F.split_part("session", F.lit("-"), F.lit(3))
    text = F.concat_ws("-", F.substring(year, 1, 4), F.substring(day, 1, 2), F.substring(day, 3, 2))
    return out.withColumn("paid_on", F.date_add(F.to_date(text, "yyyy-MM-dd"), 1))


@query("""
WITH money AS (SELECT user_id, ts, event_id, event_type, nullif(event_type, 'error') AS content,
  cast(round(value * 100) AS bigint) * CASE WHEN event_type IN ('click', 'error') THEN -1 ELSE 1 END AS amount FROM events)
SELECT user_id, max(ts) AS max_at, min(ts) AS min_at,
  cast(sum(CASE WHEN amount >= 0 THEN amount END) AS bigint) AS positive_amount,
  cast(sum(CASE WHEN amount < 0 THEN amount END) AS bigint) AS negative_amount,
  string_agg(cast(event_id AS varchar), ',' ORDER BY ts, event_id) AS all_sessionid,
  string_agg(content, ',' ORDER BY ts, event_id) AS all_content,
  string_agg(strftime(ts, '%Y-%m-%d %H:%M:%S'), ',' ORDER BY ts, event_id) AS all_at
FROM money GROUP BY user_id
""")
def signed_reconciliation(t):
    sign = F.when(F.col("event_type").isin("click", "error"), -1).otherwise(1)
    money = t.events.select("user_id", "ts", "event_id", F.nullif("event_type", F.lit("error")).alias("content"),
                            (cents("value") * sign).alias("amount"))
    sums = money.groupBy("user_id").agg(F.max("ts").alias("max_at"), F.min("ts").alias("min_at"),
                                        *agg.signed_totals(F.col("amount"), "amount"))
    texts = agg.ordered_text(
        money, ["user_id"],
        {"all_sessionid": F.col("event_id"), "all_content": F.col("content"),
         "all_at": F.date_format("ts", "yyyy-MM-dd HH:mm:ss")},
        [F.col("ts"), F.col("event_id")])
    return rel.lookup(sums, texts, "user_id", ["all_sessionid", "all_content", "all_at"])


@query("""
WITH bank AS (SELECT user_id, cast(sum(round(value * 100)) AS bigint) AS bankvalue, max(ts) AS last_at, count(props) AS n
  FROM events WHERE event_type = 'purchase' GROUP BY user_id),
all_users AS (SELECT user_id, count(*) AS n_events FROM events GROUP BY user_id)
SELECT a.user_id, n_events, coalesce(bankvalue, 0) AS bankvalue, last_at, coalesce(n, 0) AS n_transfers
FROM all_users a LEFT JOIN bank ON a.user_id = bank.user_id
""")
def bank_totals(t):
    bank = agg.totals(t.events.filter("event_type = 'purchase'"), "user_id", sums={"bankvalue": cents("value")},
                      maxs={"last_at": F.col("ts")}, counts={"n_transfers": F.col("props")})
    users = t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"))
    out = rel.lookup(users, bank, "user_id", ["bankvalue", "last_at", "n_transfers"])
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("bankvalue", "n_transfers")})


@query("""
WITH scan AS (SELECT l_orderkey, 'P' || l_partkey AS sku, count(l_partkey) AS n, max(l_shipdate) AS last_at
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL),
line AS (SELECT l_orderkey, 'P' || l_partkey || '_' || l_linenumber AS productid, l_quantity, l_shipdate FROM lineitem)
SELECT line.l_orderkey, productid, l_quantity, coalesce(n, 0) AS return_quantity,
  greatest(l_shipdate, coalesce(last_at, l_shipdate)) AS updated_at
FROM line LEFT JOIN scan ON line.l_orderkey = scan.l_orderkey AND split_part(productid, '_', 1) = sku
""")
def return_counts(t):
    scans = t.lineitem.filter("l_returnflag = 'R'").select(
        "l_orderkey", F.concat(F.lit("P"), "l_partkey").alias("sku"), "l_shipdate")
    scans = agg.totals(scans, ["l_orderkey", "sku"], counts={"n": F.col("sku")}, maxs={"last_at": F.col("l_shipdate")})
    lines = t.lineitem.select(
        "l_orderkey", F.concat(F.lit("P"), "l_partkey", F.lit("_"), "l_linenumber").alias("productid"), "l_quantity",
        F.lit(0).cast("bigint").alias("return_quantity"), F.col("l_shipdate").alias("updated_at"))
    lines = lines.withColumn("sku", sku_prefix(F.col("productid"), "_"))
    return rel.update_from(lines, scans, ["l_orderkey", "sku"], {
        "return_quantity": lambda old, right: F.coalesce(right("n"), old),
        "updated_at": lambda old, right: F.greatest(old, right("last_at"))}).drop("sku")


@query("""
WITH line AS (SELECT l_orderkey, l_partkey, nullif(l_returnflag, 'A') AS flag, l_suppkey,
  cast(round(l_discount * 100) AS bigint) AS off, cast(round(l_tax * 100) AS bigint) AS tax FROM lineitem),
grouped AS (SELECT l_orderkey, l_partkey, flag, l_suppkey, count(*) AS quantity, cast(sum(off) AS bigint) AS off,
  cast(sum(tax) AS bigint) AS tax FROM line WHERE flag IS NOT NULL GROUP BY l_orderkey, l_partkey, flag, l_suppkey)
SELECT * FROM grouped
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY flag, l_suppkey) = 1
""")
def collapse_lines(t):
    lines = t.lineitem.select(
        "l_orderkey", "l_partkey", F.nullif("l_returnflag", F.lit("A")).alias("flag"), "l_suppkey",
        cents("l_discount").alias("off"), cents("l_tax").alias("tax"))
    grouped = agg.collapse(lines, ["l_orderkey", "l_partkey", "flag", "l_suppkey"], ["off", "tax"], "quantity")
    return win.first_per_key(grouped, ["l_orderkey", "l_partkey"], [F.col("flag"), F.col("l_suppkey")])


@query("""
SELECT l_orderkey, l_linenumber, l_partkey,
  -(coalesce(cast(floor(l_extendedprice * l_discount * 100 + 0.5) AS bigint), 0)
    + coalesce(CASE WHEN l_returnflag <> 'R' THEN cast(floor(l_extendedprice * l_tax * 100 + 0.5) AS bigint) END, 0)
    + coalesce(nullif(cast(l_quantity AS bigint), 1), 0)) AS shipping_cost
FROM lineitem
""")
def fee_row_sum(t):
    fees = [
        cents(F.col("l_extendedprice") * F.col("l_discount")),
        F.when(F.col("l_returnflag") != "R", cents(F.col("l_extendedprice") * F.col("l_tax"))),
        F.nullif(F.col("l_quantity").cast("bigint"), F.lit(1)),
    ]
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", sum_columns(fees, -1).alias("shipping_cost"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey,
  cast(l_quantity AS bigint) + l_suppkey AS buyer_fee,
  CASE WHEN l_returnflag <> 'R' THEN cast(l_linenumber AS bigint) + l_partkey END AS seller_fee
FROM lineitem
""")
def nested_fee_sum(t):
    text = F.when(F.col("l_returnflag") == "R", F.lit("n/a")).otherwise(F.col("l_linenumber").cast("string"))
    nested = t.lineitem.withColumn("shipping_fee", F.array(
        F.struct(F.col("l_quantity").cast("bigint").cast("string").alias("buyer"), text.alias("seller")),
        F.struct(F.col("l_suppkey").cast("string").alias("buyer"), F.col("l_partkey").cast("string").alias("seller"))))
    return nested.select("l_orderkey", "l_linenumber", "l_partkey",
                         sum_array(F.col("shipping_fee"), "buyer").alias("buyer_fee"),
                         sum_array(F.col("shipping_fee"), "seller").alias("seller_fee"))


@query("""
SELECT o_orderkey, o_orderstatus, cast(coalesce(sum(l_quantity), 0) AS bigint) AS total_quantity,
  cast(coalesce(sum(cast(l_quantity AS bigint) * 100 * 1000 - cast(floor(l_extendedprice * l_discount * 100 + 0.5) AS bigint)), 0)
       AS bigint) AS total_amount
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_orderstatus
""")
def order_totals(t):
    qty = F.col("l_quantity").cast("bigint")
    off = cents(F.col("l_extendedprice") * F.col("l_discount"))
    sums = agg.totals(t.lineitem, "l_orderkey", sums={"total_quantity": qty, "total_amount": qty * 100_000 - off})
    out = rel.lookup(t.orders.select("o_orderkey", "o_orderstatus"), sums, {"o_orderkey": "l_orderkey"},
                     ["total_quantity", "total_amount"])
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("total_quantity", "total_amount")})


@query("""
WITH line AS (SELECT l_orderkey, l_linenumber, l_partkey, cast(round(l_extendedprice * 100) AS bigint) AS amount FROM lineitem)
SELECT *, cast(sum(amount) OVER (PARTITION BY l_orderkey) AS bigint) AS order_amount,
  CASE WHEN sum(amount) OVER (PARTITION BY l_orderkey) = 0 THEN 0.0
       ELSE cast(amount AS double) / cast(sum(amount) OVER (PARTITION BY l_orderkey) AS double) END AS share
FROM line
""")
def order_share_window(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", cents("l_extendedprice").alias("amount"))
    out = agg.with_totals(lines, ["l_orderkey"], {"order_amount": F.col("amount")})
    return out.withColumn("share", safe_ratio(F.col("amount"), F.col("order_amount")))


@query("""
WITH sheet AS (SELECT user_id, event_id, CASE WHEN event_type IN ('purchase', 'signup')
    THEN cast(round(value) AS bigint) END AS cell FROM events),
filled AS (SELECT *, last_value(cell IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS amount FROM sheet),
marked AS (SELECT *, CASE WHEN amount = lag(amount) OVER (PARTITION BY user_id ORDER BY event_id) THEN 0 ELSE 1 END AS start
    FROM filled),
numbered AS (SELECT *, cast(sum(start) OVER (PARTITION BY user_id ORDER BY event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bigint) AS run_id FROM marked)
SELECT user_id, event_id, amount, run_id, count(*) OVER (PARTITION BY user_id, run_id) AS run_rows,
    cast(amount AS double) / cast(count(*) OVER (PARTITION BY user_id, run_id) AS double) AS part
FROM numbered
""")
def fill_down_even_split(t):
    cell = F.when(F.col("event_type").isin("purchase", "signup"), whole("value"))
    sheet = t.events.select("user_id", "event_id", cell.alias("amount"))
    filled = win.fill_down(sheet, ["amount"], "user_id", "event_id", block_rows=4096)
    numbered = win.runs(filled, "amount", "user_id", "event_id", block_rows=4096)
    sized = win.with_group_size(numbered, ["user_id", "run_id"], "run_rows")
    return sized.withColumn("part", F.col("amount") / F.col("run_rows"))


@query("""
WITH run AS (
  WITH sheet AS (SELECT user_id, event_id, event_type,
      CASE WHEN event_type = lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) THEN 0 ELSE 1 END AS start
    FROM events)
  SELECT *, sum(start) OVER (PARTITION BY user_id ORDER BY event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run_id FROM sheet)
SELECT user_id, event_id, event_type, 1000.0 / cast(count(*) OVER (PARTITION BY user_id, run_id) AS double) AS part FROM run
""")
def run_even_split(t):
    sheet = t.events.select("user_id", "event_id", "event_type")
    numbered = win.runs(sheet, "event_type", "user_id", "event_id", block_rows=4096)
    sized = win.with_group_size(numbered, ["user_id", "run_id"], "n")
    return sized.select("user_id", "event_id", "event_type", (F.lit(1000.0) / F.col("n")).alias("part"))


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_shipdate FROM lineitem WHERE l_returnflag = 'R'
QUALIFY row_number() OVER (PARTITION BY l_orderkey
  ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) = 1
""")
def latest_return_per_order(t):
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    rows = t.lineitem.filter("l_returnflag = 'R'").select("l_orderkey", *order)
    return win.latest_per_key(rows, "l_orderkey", [F.col(c) for c in order])


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1
""")
def duplicate_members(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return win.duplicates(rows, ["l_orderkey", "l_linenumber"])
