"""Filters, joins, deletes and unions."""

from datetime import datetime

from pyspark.sql import functions as F

from orderloom.functions.rules import is_not, not_in, out_of_range, overwrite_where, rule_cascade
from orderloom.operators import quality, relational as rel
from orderloom.operators.aggregates import average_price
from orderloom.plans.registry import cents, query


@query("""
SELECT o_orderkey, o_orderdate, o_orderstatus, l_partkey, l_linenumber, l_quantity, l_extendedprice
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
""")
def order_headers_with_lines(t):
    return rel.lookup(
        t.orders.select("o_orderkey", "o_orderdate", "o_orderstatus"), t.lineitem, {"o_orderkey": "l_orderkey"},
        ["l_partkey", "l_linenumber", "l_quantity", "l_extendedprice"])


@query("""
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'F' THEN 'thanh cong' WHEN o_orderstatus IN ('O', 'X') THEN 'dang giao'
            ELSE 'khac' END AS label,
       CASE WHEN parent = '3-MEDIUM' THEN 1 ELSE 0 END AS is_medium,
       coalesce(parent, 'khong ro') AS parent
FROM (SELECT *, nullif(o_orderpriority, '4-NOT SPECIFIED') AS parent FROM orders)
WHERE parent NOT IN ('1-URGENT', '2-HIGH') OR (parent IS NULL AND o_orderstatus IN ('F', 'P'))
""")
def status_code_filter(t):
    parent, status = F.col("parent"), F.col("o_orderstatus")
    rows = t.orders.withColumn("parent", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")))
    kept = rel.keep_where(rows, not_in(parent, ("1-URGENT", "2-HIGH")) | (parent.isNull() & status.isin("F", "P")))
    label = rule_cascade([(status == "F", "thanh cong"), (status.isin("O", "X"), "dang giao")], "khac")
    return rel.to_contract(kept, {
        "o_orderkey": "o_orderkey", "label": label,
        "is_medium": F.when(parent == "3-MEDIUM", 1).otherwise(0),
        "parent": F.coalesce(parent, F.lit("khong ro"))})


@query("""
SELECT page_id, url,
       CASE WHEN regexp_matches(url, '^https://[a-z]+\\.example\\.(com|org)/[a-z]{2}/\\d+$') THEN 'kept'
            ELSE 'rejected' END AS verdict
FROM pages
""")
def reject_invalid_ids(t):
    pages = t.pages.select("page_id", "url")
    kept, rejected = quality.expect_or_drop(
        pages, F.col("url").rlike(r"^https://[a-z]+\.example\.(com|org)/[a-z]{2}/\d+$"))
    return rel.union_all(kept.withColumn("verdict", F.lit("kept")), rejected.withColumn("verdict", F.lit("rejected")))


@query("""
SELECT event_id, kind, CASE WHEN kind IS NULL THEN 0.0 ELSE value END AS value
FROM (SELECT *, nullif(event_type, 'error') AS kind FROM events)
WHERE kind IS DISTINCT FROM 'click' AND (kind IS NULL OR kind NOT LIKE '%up') AND props IS NOT NULL
""")
def null_keeping_filter(t):
    kind = F.col("kind")
    rows = t.events.withColumn("kind", F.nullif("event_type", F.lit("error")))
    rows = rel.keep_where(rows, is_not(kind, "click") & ~F.coalesce(kind.endswith("up"), F.lit(False))
                          & F.col("props").isNotNull())
    return rows.select("event_id", "kind",
                       overwrite_where(F.col("value"), kind.isNull(), F.lit(0.0)).alias("value"))


@query("""
WITH listed AS (
  SELECT n_nationkey AS code, n_name AS label, 0 AS seq FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE r_name <> 'EUROPE'
  UNION ALL
  SELECT n_nationkey, 'chau a ' || n_name, 1 FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE r_name = 'ASIA'),
winner AS (SELECT code, arg_max(label, seq) AS label FROM listed GROUP BY code)
SELECT c_custkey, c_name, label AS city FROM customer LEFT JOIN winner ON c_nationkey = code
""")
def code_label_map(t):
    named = rel.lookup(t.nation, t.region, {"n_regionkey": "r_regionkey"}, ["r_name"])
    listed = rel.to_contract(named.filter("r_name <> 'EUROPE'"), {"code": "n_nationkey", "label": "n_name"}, {"seq": 0})
    again = rel.to_contract(named.filter("r_name = 'ASIA'"),
                            {"code": "n_nationkey", "label": F.concat(F.lit("chau a "), "n_name")}, {"seq": 1})
    customers = t.customer.select("c_custkey", "c_name", F.col("c_nationkey").alias("city"))
    return rel.map_codes(customers, "city", rel.union_all(listed, again), "seq")


@query("""
WITH dim AS (SELECT 'P' || p_partkey AS productid FROM part WHERE p_type <> 'PROMO'),
line AS (SELECT split_part('P' || l_partkey || '-' || l_linenumber, '-', 1) AS member, l_extendedprice AS price,
                l_extendedprice * l_discount AS off, l_quantity AS qty FROM lineitem)
SELECT member AS productid, cast(round(avg(price - off / qty)) AS bigint) AS retailprice, count(*) AS n_lines
FROM line LEFT JOIN dim ON member = productid WHERE productid IS NULL GROUP BY member
""")
def late_arriving_products(t):
    dim = t.part.filter("p_type <> 'PROMO'").select(F.concat(F.lit("P"), "p_partkey").alias("productid"))
    lines = t.lineitem.select(
        F.concat(F.lit("P"), "l_partkey", F.lit("-"), "l_linenumber").alias("sku"),
        F.col("l_extendedprice").alias("price"), (F.col("l_extendedprice") * F.col("l_discount")).alias("off"),
        F.col("l_quantity").alias("qty"))
    missing = rel.missing_members(lines, F.substring_index("sku", "-", 1), dim, "productid")
    priced = average_price(missing, "member", F.col("price"), F.col("off"), F.col("qty"))
    sizes = missing.groupBy("member").agg(F.count(F.lit(1)).alias("n_lines"))
    return rel.lookup(priced, sizes, "member", ["n_lines"]).select(
        F.col("member").alias("productid"), F.col("retailprice").cast("bigint"), "n_lines")


@query("""
WITH dim AS (SELECT 'S' || s_suppkey AS tracking FROM supplier WHERE s_acctbal >= 2000
             UNION SELECT 'TVC_' || o_orderkey FROM orders WHERE o_orderstatus <> 'P'),
line AS (SELECT l_orderkey, l_linenumber, l_partkey,
                CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'TVC_' || l_orderkey
                     WHEN l_linestatus = 'F' THEN 'S' || l_suppkey END AS tracking FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, dim.tracking
FROM line LEFT JOIN dim ON line.tracking = dim.tracking
""")
def null_unknown_refs(t):
    dim = rel.union_all(
        t.supplier.filter("s_acctbal >= 2000").select(F.concat(F.lit("S"), "s_suppkey").alias("trackingnumber")),
        t.orders.filter("o_orderstatus <> 'P'").select(F.concat(F.lit("TVC_"), "o_orderkey").alias("trackingnumber")))
    lines = t.lineitem.withColumn(
        "tracking", F.when(F.col("l_linestatus") == "F", F.concat(F.lit("S"), "l_suppkey")))
    own = (F.col("l_returnflag") == "R") & F.col("tracking").isNull()
    lines = lines.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        overwrite_where(F.col("tracking"), own, F.concat(F.lit("TVC_"), "l_orderkey")).alias("tracking"))
    return rel.null_unmatched(lines, "tracking", dim, "trackingnumber")


@query("""
WITH doomed AS (SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('P', 'X')
                AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate <= TIMESTAMP '1999-12-31'),
line AS (SELECT * FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM doomed)),
header AS (SELECT * FROM orders WHERE NOT (o_orderstatus IN ('P', 'X')
           AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate <= TIMESTAMP '1999-12-31'))
SELECT o_orderkey, o_orderstatus, count(l_orderkey) AS n_lines, cast(coalesce(sum(l_quantity), 0) AS bigint) AS qty
FROM header LEFT JOIN line ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_orderstatus
""")
def delete_unconfirmed(t):
    start, end = datetime(1997, 1, 1), datetime(1999, 12, 31)
    unconfirmed = F.col("o_orderstatus").isin("P", "X") & F.col("o_orderdate").between(
        F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))
    lines = rel.delete_keys(t.lineitem.select("l_orderkey", "l_quantity"), t.orders.filter(unconfirmed),
                            {"l_orderkey": "o_orderkey"})
    headers = rel.delete_where(t.orders, unconfirmed).select("o_orderkey", "o_orderstatus")
    per_order = lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("qty"))
    out = rel.lookup(headers, per_order, {"o_orderkey": "l_orderkey"}, ["n_lines", "qty"])
    return out.select("o_orderkey", "o_orderstatus", F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
                      F.coalesce("qty", F.lit(0)).cast("bigint").alias("qty"))


@query("""
WITH item AS (SELECT l_orderkey, l_partkey, l_returnflag,
                concat_ws('_', l_suppkey, l_linenumber, cast(l_quantity AS bigint)) AS line_key, l_extendedprice
              FROM lineitem),
escrow AS (SELECT l_orderkey, l_partkey,
                concat_ws('_', l_suppkey, l_linenumber, cast(l_quantity AS bigint)) AS line_key,
                cast(sum(floor(l_extendedprice * l_discount * 100 + 0.5)) AS bigint) AS off
              FROM lineitem WHERE l_returnflag <> 'N' GROUP BY ALL)
SELECT item.l_orderkey, item.l_partkey, item.line_key, l_extendedprice, off
FROM item LEFT JOIN escrow ON item.l_orderkey = escrow.l_orderkey AND item.l_partkey = escrow.l_partkey
  AND item.line_key = escrow.line_key
""")
def composite_key_join(t):
    key = F.concat_ws("_", "l_suppkey", "l_linenumber", F.col("l_quantity").cast("bigint"))
    items = t.lineitem.withColumn("line_key", key)
    off = cents(F.col("l_extendedprice") * F.col("l_discount"))
    escrow = items.filter("l_returnflag <> 'N'").groupBy("l_orderkey", "l_partkey", "line_key").agg(
        F.sum(off).alias("off"))
    return rel.lookup(items.select("l_orderkey", "l_partkey", "line_key", "l_extendedprice"), escrow,
                      ["l_orderkey", "l_partkey", "line_key"], ["off"])


@query("""
SELECT o_orderkey, o_totalprice, c_mktsegment, n_name, r_name
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey
""")
def lookup_chain(t):
    rows = rel.lookup(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), t.customer,
                      {"o_custkey": "c_custkey"}, ["c_mktsegment", "c_nationkey"])
    rows = rel.lookup(rows, t.nation, {"c_nationkey": "n_nationkey"}, ["n_name", "n_regionkey"])
    rows = rel.lookup(rows, t.region, {"n_regionkey": "r_regionkey"}, ["r_name"])
    return rows.select("o_orderkey", "o_totalprice", "c_mktsegment", "n_name", "r_name")


@query("""
SELECT o_orderkey, status, courier, courier_account, CAST(NULL AS VARCHAR) AS note, 0 AS compensation FROM (
  SELECT o_orderkey, o_orderstatus AS status, 'Giao Hang Tiet Kiem' AS courier, o_orderpriority AS courier_account
  FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL SELECT o_orderkey, 'Don huy', NULL, NULL FROM orders WHERE o_orderstatus = 'P')
""")
def union_cancelled(t):
    sent = t.orders.filter("o_orderstatus <> 'P'").select(
        "o_orderkey", F.col("o_orderstatus").alias("status"), F.lit("Giao Hang Tiet Kiem").alias("courier"),
        F.col("o_orderpriority").alias("courier_account"))
    cancelled = t.orders.filter("o_orderstatus = 'P'").select("o_orderkey", F.lit("Don huy").alias("status"))
    both = rel.union_all(sent, cancelled)
    return rel.to_contract(both, {c: c for c in both.columns}, {"note": F.lit(None).cast("string"), "compensation": 0})


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity
FROM lineitem WHERE (l_extendedprice < 3000 AND l_extendedprice <> 0) OR l_extendedprice > 100000
""")
def outlier_check(t):
    return t.lineitem.filter(out_of_range(F.col("l_extendedprice"), 3000, 100_000)).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")


@query("""
WITH ok AS (SELECT count(*) AS n FROM part WHERE regexp_matches(p_brand, '^Brand#\\d{2}$')),
priced AS (SELECT count(*) AS n FROM part WHERE p_retailprice > 0)
SELECT p_partkey, p_brand, p_retailprice FROM part WHERE (SELECT n FROM ok) >= 1000 AND (SELECT n FROM priced) >= 1000
""")
def volume_gate(t):
    parts = t.part.select("p_partkey", "p_brand", "p_retailprice")
    checks = {"sku": F.col("p_brand").rlike(r"^Brand#\d{2}$"), "price": F.col("p_retailprice") > 0}
    return quality.volume_gate(parts, checks, 1000)
