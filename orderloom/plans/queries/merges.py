"""Keyed merges, high-water marks and joined updates."""

from datetime import datetime

from pyspark.sql import functions as F

from orderloom.operators import merge, relational as rel, tracking
from orderloom.plans import star
from orderloom.plans.registry import cents, query, whole

RUN = datetime(2024, 2, 1, 8)
BEFORE = datetime(2024, 1, 1, 8)


def _stored(t):
    """Orders up to 1998 as a staging table."""
    return tracking.stamp(t.orders.filter("o_orderdate < TIMESTAMP_NTZ'1999-01-01'").select(
        F.col("o_orderkey").alias("orderid"), F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        cents("o_totalprice").alias("price")), BEFORE)


def _late(t):
    return t.orders.filter("o_orderdate >= TIMESTAMP_NTZ'1997-01-01'")


STORED = """stored AS (SELECT o_orderkey AS orderid, nullif(o_orderstatus, 'P') AS status,
  cast(round(o_totalprice * 100) AS bigint) AS price, TIMESTAMP '2024-01-01 08:00:00' AS dw_updatedat
  FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
late AS (SELECT o_orderkey, o_orderpriority, nullif(o_orderstatus, 'P') AS status,
  cast(round(o_totalprice * 100) AS bigint) AS price FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01')"""


@query(f"""
WITH {STORED},
batch AS (
  SELECT o_orderkey AS orderid, 'da gui' AS status, price + 1 AS price, 1 AS row_no FROM late
  UNION ALL SELECT o_orderkey, CAST(NULL AS VARCHAR), cast(round(o_totalprice * 100) AS bigint), 2
  FROM orders WHERE o_orderstatus = 'P'),
source AS (SELECT * FROM batch QUALIFY row_number() OVER (PARTITION BY orderid ORDER BY row_no DESC) = 1)
SELECT coalesce(t.orderid, s.orderid) AS orderid,
  CASE WHEN s.orderid IS NULL THEN t.status ELSE s.status END AS status,
  CASE WHEN s.orderid IS NULL THEN t.price ELSE s.price END AS price,
  CASE WHEN s.orderid IS NULL THEN t.dw_updatedat ELSE TIMESTAMP '2024-02-01 08:00:00' END AS dw_updatedat
FROM stored t FULL OUTER JOIN source s ON t.orderid = s.orderid
""")
def upsert_replace(t):
    sent = _late(t).select(F.col("o_orderkey").alias("orderid"), F.lit("da gui").alias("status"),
                           (cents("o_totalprice") + 1).alias("price"), F.lit(1).alias("row_no"))
    again = t.orders.filter("o_orderstatus = 'P'").select(
        F.col("o_orderkey").alias("orderid"), F.lit(None).cast("string").alias("status"),
        cents("o_totalprice").alias("price"), F.lit(2).alias("row_no"))
    batch = tracking.stamp(rel.union_all(sent, again), RUN)
    return merge.upsert(_stored(t), batch, ["orderid"], order_col="row_no")


@query(f"""
WITH {STORED},
batch AS (
  SELECT o_orderkey AS orderid, status, price + CASE o_orderpriority WHEN '1-URGENT' THEN 1 ELSE 0 END AS price,
    2 AS row_no FROM late
  UNION ALL SELECT o_orderkey, status, price + 5, 1 FROM late WHERE o_orderpriority = '2-HIGH'),
source AS (SELECT * FROM batch QUALIFY row_number() OVER (PARTITION BY orderid ORDER BY row_no DESC) = 1),
moved AS (SELECT b.orderid, max(CASE WHEN t.orderid IS NULL OR b.status IS DISTINCT FROM t.status
    OR b.price IS DISTINCT FROM t.price THEN 1 ELSE 0 END) AS moved
  FROM batch b LEFT JOIN stored t ON b.orderid = t.orderid GROUP BY b.orderid)
SELECT coalesce(t.orderid, s.orderid) AS orderid,
  CASE WHEN s.orderid IS NULL THEN t.status ELSE s.status END AS status,
  CASE WHEN s.orderid IS NULL THEN t.price ELSE s.price END AS price,
  CASE WHEN coalesce(moved, 0) = 1 THEN TIMESTAMP '2024-02-01 08:00:00' ELSE t.dw_updatedat END AS dw_updatedat
FROM stored t FULL OUTER JOIN source s ON t.orderid = s.orderid LEFT JOIN moved ON moved.orderid = s.orderid
""")
def upsert_changed(t):
    extra = F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)
    status = F.nullif("o_orderstatus", F.lit("P")).alias("status")
    now = _late(t).select(F.col("o_orderkey").alias("orderid"), status,
                          (cents("o_totalprice") + extra).alias("price"), F.lit(2).alias("row_no"))
    first = _late(t).filter("o_orderpriority = '2-HIGH'").select(
        F.col("o_orderkey").alias("orderid"), status, (cents("o_totalprice") + 5).alias("price"),
        F.lit(1).alias("row_no"))
    batch = tracking.stamp(rel.union_all(now, first), RUN)
    return merge.upsert(_stored(t), batch, ["orderid"], mode="changed", order_col="row_no")


@query("""
WITH stored AS (SELECT event_id AS parcel, CASE WHEN event_type <> 'error' THEN cast(ts AS date) END AS scan_at,
    event_type AS note1, CAST(NULL AS VARCHAR) AS note2, TIMESTAMP '2024-01-01 08:00:00' AS dw_updatedat
  FROM events WHERE event_type <> 'signup'),
scan AS (SELECT event_id AS parcel, cast(ts AS date) + CASE event_type WHEN 'purchase' THEN 1 ELSE 0 END AS scan_at
  FROM events WHERE value > 10),
note AS (SELECT event_id AS parcel, CASE event_type WHEN 'click' THEN 'goi lai' END AS note1,
  CASE WHEN user_id < 75 THEN 'hen ' || user_id END AS note2 FROM events WHERE value <= 30),
source AS (SELECT coalesce(scan.parcel, note.parcel) AS parcel, scan_at, note1, note2
  FROM scan FULL OUTER JOIN note ON scan.parcel = note.parcel)
SELECT coalesce(t.parcel, s.parcel) AS parcel, coalesce(s.scan_at, t.scan_at) AS scan_at,
  coalesce(s.note1, t.note1) AS note1, coalesce(s.note2, t.note2) AS note2,
  CASE WHEN t.parcel IS NULL OR (s.scan_at IS NOT NULL AND s.scan_at IS DISTINCT FROM t.scan_at)
         OR (s.note1 IS NOT NULL AND s.note1 IS DISTINCT FROM t.note1)
         OR (s.note2 IS NOT NULL AND s.note2 IS DISTINCT FROM t.note2)
       THEN TIMESTAMP '2024-02-01 08:00:00' ELSE t.dw_updatedat END AS dw_updatedat
FROM stored t FULL OUTER JOIN source s ON t.parcel = s.parcel
""")
def upsert_coalesce(t):
    ev = t.events
    stored = tracking.stamp(ev.filter("event_type <> 'signup'").select(
        F.col("event_id").alias("parcel"),
        F.when(F.col("event_type") != "error", F.to_date("ts")).alias("scan_at"), F.col("event_type").alias("note1"),
        F.lit(None).cast("string").alias("note2")), BEFORE)
    later = F.when(F.col("event_type") == "purchase", 1).otherwise(0)
    scans = ev.filter("value > 10").select(
        F.col("event_id").alias("parcel"), F.date_add(F.to_date("ts"), later).alias("scan_at"), F.lit(1).alias("row_no"))
    notes = ev.filter("value <= 30").select(
        F.col("event_id").alias("parcel"), F.when(F.col("event_type") == "click", F.lit("goi lai")).alias("note1"),
        F.when(F.col("user_id") < 75, F.concat(F.lit("hen "), "user_id")).alias("note2"), F.lit(2).alias("row_no"))
    batch = tracking.stamp(rel.union_all(scans, notes), RUN)
    return merge.upsert(stored, batch, ["parcel"], mode="coalesce", order_col="row_no")


@query("""
WITH stored AS (SELECT DISTINCT l_orderkey AS id, 'cu' AS content FROM lineitem WHERE l_returnflag = 'R'),
source AS (SELECT o_orderkey AS id FROM orders UNION SELECT l_orderkey FROM lineitem)
SELECT * FROM stored UNION ALL SELECT id, NULL FROM source WHERE id NOT IN (SELECT id FROM stored)
""")
def insert_ignore(t):
    stored = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("id")).distinct()
    source = rel.union_all(t.orders.select(F.col("o_orderkey").alias("id")),
                           t.lineitem.select(F.col("l_orderkey").alias("id")))
    return merge.insert_ignore(stored.withColumn("content", F.lit("cu")), source, ["id"])


@query("""
WITH stored AS (SELECT l_orderkey AS trackingnumber, 'GHN' AS courier, max(l_returnflag) AS delivery_status,
    min(l_shipdate) AS createdat, 'ghi chu ' || max(l_linenumber) AS note, 0 AS fee
  FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_orderkey),
source AS (SELECT o_orderkey AS trackingnumber, o_orderstatus AS delivery_status, o_orderdate AS createdat FROM orders
  WHERE o_orderpriority <> '5-LOW')
SELECT coalesce(t.trackingnumber, s.trackingnumber) AS trackingnumber,
  CASE WHEN t.trackingnumber IS NULL THEN 'SPX' ELSE t.courier END AS courier,
  coalesce(s.delivery_status, t.delivery_status) AS delivery_status,
  CASE WHEN t.trackingnumber IS NULL THEN s.createdat ELSE t.createdat END AS createdat, t.note,
  coalesce(t.fee, 7) AS fee
FROM stored t FULL OUTER JOIN source s ON t.trackingnumber = s.trackingnumber
""")
def upsert_subset_keep(t):
    stored = t.lineitem.filter("l_linestatus = 'F'").groupBy(F.col("l_orderkey").alias("trackingnumber")).agg(
        F.lit("GHN").alias("courier"), F.max("l_returnflag").alias("delivery_status"),
        F.min("l_shipdate").alias("createdat"), F.concat(F.lit("ghi chu "), F.max("l_linenumber")).alias("note"),
        F.lit(0).alias("fee"))
    source = t.orders.filter("o_orderpriority <> '5-LOW'").select(
        F.col("o_orderkey").alias("trackingnumber"), F.col("o_orderstatus").alias("delivery_status"),
        F.col("o_orderdate").alias("createdat"))
    return merge.upsert(stored, source, ["trackingnumber"], update_cols=["delivery_status"],
                        insert_defaults={"courier": "SPX", "fee": 7}, stamp_col=None)


@query("""
WITH shop AS (SELECT o_orderkey AS id, o_orderdate AS createdat, 'Shopee shops' AS platform,
    CASE o_orderstatus WHEN 'O' THEN 'khach doi y' END AS cancel_reason FROM orders WHERE o_orderpriority <> '1-URGENT'),
pos AS (SELECT o_orderkey AS id, max(l_shipdate) AS createdat, 'di moi' AS parentsource FROM orders
  JOIN lineitem ON o_orderkey = l_orderkey WHERE l_returnflag = 'R' GROUP BY o_orderkey)
SELECT coalesce(shop.id, pos.id) AS id, coalesce(pos.createdat, shop.createdat) AS createdat, platform, cancel_reason,
  parentsource
FROM shop FULL OUTER JOIN pos ON shop.id = pos.id
""")
def feeds_one_merge(t):
    target = t.orders.filter(F.lit(False)).select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("createdat"),
        *[F.lit(None).cast("string").alias(c) for c in ("platform", "cancel_reason", "parentsource")])
    shop = t.orders.filter("o_orderpriority <> '1-URGENT'").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("createdat"), F.lit("Shopee shops").alias("platform"),
        F.when(F.col("o_orderstatus") == "O", "khach doi y").alias("cancel_reason"))
    pos = t.lineitem.filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("id"), F.col("l_shipdate").alias("createdat"), F.lit("di moi").alias("parentsource"),
        F.col("l_shipdate").alias("__at"))
    return merge.upsert_feeds(target, [(shop, []), (pos, ["__at"])], ["id"])


PARCEL_SQL = """parcel AS (SELECT 'T' || o_orderkey AS id,
    CASE o_orderstatus WHEN 'F' THEN 'Da giao hang' WHEN 'O' THEN 'Huy'
      ELSE CASE WHEN o_orderpriority = '2-HIGH' THEN 'Ky nhan chuyen hoan' ELSE 'Da tra hang' END END AS status,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN 20000 + o_custkey END AS cost,
    CASE WHEN o_orderpriority <> '5-LOW' THEN cast(round(o_totalprice) AS bigint) END AS cod, o_orderdate AS at
  FROM orders WHERE o_orderpriority <> '1-URGENT')"""


@query(f"""
WITH {PARCEL_SQL},
fact AS (SELECT l_orderkey, l_linenumber, l_partkey, 'T' || l_orderkey AS deliveryid, l_quantity * 1.0 AS fee, 5.0 AS cod,
    l_shipdate AS at FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN id IS NULL OR cost IS NULL THEN fee WHEN status = 'Huy' THEN 0.0 ELSE cast(cost AS double) END AS fee,
  CASE WHEN id IS NULL OR parcel.cod IS NULL THEN fact.cod WHEN status IN ('Huy', 'Ky nhan chuyen hoan') THEN 0.0
       ELSE cast(parcel.cod AS double) END AS cod,
  CASE WHEN id IS NULL THEN fact.at ELSE greatest(parcel.at, fact.at) END AS lastupdateat
FROM fact LEFT JOIN parcel ON deliveryid = id
""")
def update_from_rules(t):
    status = F.when(F.col("o_orderstatus") == "F", "Da giao hang").when(F.col("o_orderstatus") == "O", "Huy").when(
        F.col("o_orderpriority") == "2-HIGH", "Ky nhan chuyen hoan").otherwise("Da tra hang")
    parcels = t.orders.filter("o_orderpriority <> '1-URGENT'").select(
        F.concat(F.lit("T"), "o_orderkey").alias("delivery_orderid"), status.alias("orderstatus"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_custkey") + 20000).alias("shippingcost"),
        F.when(F.col("o_orderpriority") != "5-LOW", whole("o_totalprice")).alias("cod_collected"),
        F.col("o_orderdate").alias("dw_updatedat"))
    fact = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.concat(F.lit("T"), "l_orderkey").alias("deliveryid"),
        F.col("l_quantity").alias("baseorder_shippingfee"), F.lit(5.0).alias("baseorder_cod_collected_allquantity"),
        F.col("l_shipdate").alias("lastupdateat"))
    out = star.apply_parcels(fact, parcels)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.col("baseorder_shippingfee").alias("fee"),
                      F.col("baseorder_cod_collected_allquantity").alias("cod"), "lastupdateat")


@query("""
WITH log AS (SELECT event_type AS name, max(ts) AS mark FROM events
  WHERE ts < TIMESTAMP '2024-01-20' AND event_type <> 'view' GROUP BY event_type),
fresh AS (SELECT event_type, count(*) AS n_new, cast(sum(round(value * 100)) AS bigint) AS amount, max(ts) AS next_mark
  FROM events LEFT JOIN log ON event_type = name WHERE ts > coalesce(mark, TIMESTAMP '1970-01-01') GROUP BY event_type)
SELECT event_type, n_new, amount, next_mark FROM fresh
""")
def watermark_delta(t):
    ev = t.events
    earlier = ev.filter("ts < TIMESTAMP_NTZ'2024-01-20' AND event_type <> 'view'")
    log = earlier.groupBy(F.col("event_type").alias("dwtable_name")).agg(F.max("ts").alias("updatetime"))
    fresh = tracking.since_each(ev, "event_type", tracking.watermarks(log), "ts")
    sums = fresh.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_new"), F.sum(cents("value")).alias("amount"))
    after = tracking.advance_each(log, fresh, "event_type", "ts")
    newest = after.groupBy("dwtable_name").agg(F.max("updatetime").alias("next_mark"))
    return rel.lookup(sums, newest, {"event_type": "dwtable_name"}, ["next_mark"])


@query("""
WITH touched AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate > TIMESTAMP '2001-06-01')
SELECT o_custkey, count(*) AS n_orders, cast(sum(round(o_totalprice * 100)) AS bigint) AS amount,
  max(o_orderdate) AS last_at, min(o_orderdate) AS first_at
FROM orders WHERE o_custkey IN (SELECT o_custkey FROM touched) GROUP BY o_custkey
""")
def changed_group_history(t):
    rows = tracking.changed_groups(t.orders, ["o_custkey"], datetime(2001, 6, 1), "o_orderdate")
    return rows.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum(cents("o_totalprice")).alias("amount"),
        F.max("o_orderdate").alias("last_at"), F.min("o_orderdate").alias("first_at"))
