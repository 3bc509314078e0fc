"""Where rows lie: what is shuffled, and how evenly."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from orderloom import session
from orderloom.operators import aggregates
from orderloom.operators import relational as rel
from orderloom.operators.settlement import settle
from orderloom.plans import partials, reports, roles, star
from orderloom.plans.queries import warehouse
from orderloom.plans.registry import QUERIES
from orderloom.schemas import empty

MONEY = ("shippingfee", "negative_reconciliation_allquantity", "cod_collected_allquantity", "codbank_collected_allquantity",
         "positive_reconciliation_allquantity", "codprepaid_allquantity")


@pytest.fixture
def plain(spark):
    """No broadcasts and no coalescing, so that plans and partitions are those of large tables."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def exchanges(df):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", df._jdf.queryExecution().executedPlan().toString())


def test_rows_without_a_reference_are_dealt_out(plain):
    """F8: they were all in one task."""
    df = plain.range(1000).select("id", F.when(F.col("id") == 1, "a").when(F.col("id") == 2, "b").alias("ref"))
    # a member that looks like the hash of a row without a reference is still not its reference
    odd = df.filter("id = 3").select(F.xxhash64("id", "ref").cast("string")).first()[0]
    dim = plain.createDataFrame([("a",), ("a",), (None,), (odd,)], "k string")
    out = rel.null_unmatched(df, "ref", dim, "k")
    assert sorted((r.id, r.ref) for r in out.filter("id < 5").collect()) == [(0, None), (1, "a"), (2, None), (3, None), (4, None)]
    tasks = out.filter("ref IS NULL").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(tasks) > 1 and sum(r["count"] for r in tasks) == 999 and max(r["count"] for r in tasks) < 600


def test_settled_lines_are_shuffled_once_by_order(plain):
    """lines that lie by order stay there for all sums and for the header."""
    numbers = [F.lit(float(i)).alias(f"baseorder_{n}") for i, n in enumerate((
        "shippingfee", "cod_collected_allquantity", "codbank_collected_allquantity", "codprepaid_allquantity",
        "positive_reconciliation_allquantity", "negative_reconciliation_allquantity"))]
    fact = plain.range(100).select(
        F.floor(F.col("id") / 3).cast("string").alias("orderid"), F.col("id").cast("string").alias("productid"), F.lit("t1").alias("deliveryid"),
        F.lit(2).alias("quantity"), F.lit(10).alias("originalprice"), F.lit(0.0).alias("discountamount_allquantity"),
        F.lit(0.0).alias("extradiscountamount_allquantity"), F.lit(0).alias("return_quantity"), *numbers,
        *[F.lit(None).cast("double").alias(n) for n in MONEY], F.lit(None).cast("string").alias("finalstatus")).repartition("orderid")
    order = plain.createDataFrame([("1", "bo sung", "thanh cong", None, "pos")], "orderid string, parentsource string, status string, return_reason string, platform string")
    parcel = plain.createDataFrame([("t1", "GHN", "Da giao hang")], "trackingnumber string, courier string, delivery_status string")
    refs = plain.range(40).select(F.col("id").cast("string").alias("orderid"), F.lit("t1").alias("deliveryid"))
    whole, split = settle(fact, order, parcel, refs=refs), settle(fact, order, parcel)
    assert sum(e.startswith("orderid#") for e in exchanges(whole)) == 2  # the lines here, and the parcels of orders
    assert {r.finalstatus for r in whole.collect()} == {"Thanh cong", "Pending"}
    assert sorted(map(str, whole.collect())) == sorted(map(str, split.collect()))


def test_first_lines_stay_with_their_order(plain):
    """The lines of three channels are folded where the joins with their headers leave them."""
    def lines(pre):
        head = plain.range(50).select(F.concat(F.lit(pre), "id").alias("orderid"), F.lit("p").alias("phone"))
        line = plain.range(150).select(F.concat(F.lit(pre), F.floor(F.col("id") / 3)).alias("orderid"), F.col("id").cast("string").alias("productid"))
        return rel.lookup(head, line, "orderid", ["productid"], aligned=True).select(
            "orderid", "productid", F.col("phone").alias("customer_surrogateid"))

    feeds = [(lines("N"), []), (lines("S"), [])]
    fact = star.merged("fact_orderdetails", empty(plain, "fact_orderdetails"), feeds, first=True)
    assert len(exchanges(fact)) == 4  # two headers, two times lines
    joined = star.merged("fact_orderdetails", empty(plain, "fact_orderdetails"), feeds)
    assert fact.count() == 300 and fact.exceptAll(joined).count() == 0


def test_returns_are_shuffled_once_by_parcel(plain):
    """They were counted by parcel and product, then shuffled by parcel for the references."""
    scans = plain.range(60).select(F.concat(F.lit("t"), F.col("id") % 20).alias("delivery_orderid"), F.concat(F.lit("p"), F.col("id") % 3).alias("productid"),
                                   F.lit("1997-01-01").cast("timestamp_ntz").alias("dw_updatedat"))
    fact = plain.range(30).select(F.concat(F.lit("o"), "id").alias("orderid"), F.concat(F.lit("t"), "id").alias("deliveryid"), F.concat(F.lit("p"), F.col("id") % 3, F.lit("_1")).alias("productid"),
                                  F.lit(0).cast("bigint").alias("return_quantity"), F.lit("1996-01-01").cast("timestamp_ntz").alias("lastupdateat"))
    refs = fact.select("orderid", "deliveryid")
    known, found = star.apply_returns(fact, scans, refs), star.apply_returns(fact, scans)
    assert sum("delivery_orderid#" in e for e in exchanges(known)) == 1
    assert sorted(known.collect()) == sorted(found.collect())
    assert {r.orderid: r.return_quantity for r in known.collect()}["o5"] == 1 and sum(r.return_quantity for r in known.collect()) == 20


def sold_tables(spark, lines):
    """Tables of one order (1), a line of no order (9) and what else staging reads, with the given lines."""
    class Tables:
        orders = spark.createDataFrame([(1, 5, "F", 10.0, datetime(1997, 6, 1), "4-NOT SPECIFIED")],
                                       "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
        customer = spark.createDataFrame([(5, "a", "BUILDING", 1)], "c_custkey long, c_name string, c_mktsegment string, c_nationkey int")
        nation = spark.createDataFrame([(1, "VN")], "n_nationkey int, n_name string")
        events = spark.createDataFrame([], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")
        lineitem = spark.createDataFrame([(o, p, s, i, 2.0, 10.0, 0.01, "R", datetime(1997, 7, 1)) for i, (o, p, s) in enumerate(lines)],
                                         "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                                         "l_returnflag string, l_shipdate timestamp_ntz")

        def spread(self, *_):
            pass

    return Tables()


def test_product_lines_are_shuffled_once_by_order(plain):
    """They were shuffled by order and product, then by order."""
    lines = [(1, 7, 3), (1, 7, 2), (1, None, 4), (9, 7, 5), (None, 7, 6)]
    lake = roles.staging(sold_tables(plain, lines))
    sold = lake["shopeeorderdetails"]
    assert len([e for e in exchanges(sold) if "l_orderkey#" in e and "__r_" not in e]) == 1
    assert sorted((r.orderid, r.product_skuid or "", r.quantity) for r in sold.collect()) == [("S1", "", 2), ("S1", "P7-2", 4)]
    scans = {(r.scan_surrogateid, r.delivery_orderid, r.productid) for r in lake["returnedorders_scan"].collect()}
    assert scans == {("1_0_7", "ST1", "P7-2"), ("1_1_7", "ST1", "P7-2"), ("1_2", "T1", None), ("9_3_7", "T9", "P7-5"), ("4_7", None, None)}


def test_partial_sums_leave_lines_with_their_order(plain):
    """lines that lie by order were shuffled by order again."""
    fact = plain.range(40).select((F.col("id") % 10).cast("string").alias("orderid"), F.lit("t").alias("deliveryid"), F.lit("Hoan").alias("finalstatus"), F.lit("p").alias("parentproductid"),
                                  *[F.lit(1).cast("bigint").alias(c) for c in ("quantity", "return_quantity", "originalprice")],
                                  *[F.lit(1).cast("decimal(20,4)").alias(c) for c in ("shippingfee", "cod_collected_allquantity")]).repartition("orderid")
    orders = plain.createDataFrame([("1", datetime(1997, 6, 1), "pos"), (None, datetime(1997, 6, 1), "pos")], "orderid string, createdat timestamp_ntz, platform string")
    parcels = plain.createDataFrame([("t", "GHN", "tk1")], "trackingnumber string, courier string, courieraccount string")
    found = partials.partials(fact, orders, parcels)
    assert len([e for e in exchanges(found) if "orderid#" in e]) == 2  # the lines here, and the orders
    assert sorted((r.month or "", r.n_lines, r.courier) for r in found.collect()) == [("", 36, "GHN"), ("1997-06", 4, "GHN")]


def test_shuffles_begin_with_more_partitions_for_larger_files(spark, tmp_path, monkeypatch):
    """A fixed number let the partitions, and with them the sorts, grow with the input."""
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    old = spark.conf.get(name, None)
    spark.range(20_000).write.parquet(f"{tmp_path}/a.parquet")
    try:
        session.spread(spark, [f"{tmp_path}/a.parquet"])
        assert spark.conf.get(name) == spark.conf.get("spark.sql.shuffle.partitions")
        monkeypatch.setattr(session, "INPUT_PER_TASK", 1 << 10)
        session.spread(spark, [f"{tmp_path}/a.parquet"])
        assert int(spark.conf.get(name)) > 50
    finally:
        spark.conf.set(name, old) if old else spark.conf.unset(name)


def test_lines_hold_no_text_of_their_order(plain):
    """the priority of an order went along as a text where its channel is asked for."""
    lines = [(1, 7, 3), (2, 7, 3), (3, 7, 3), (4, 7, 3), (5, 7, 3)]
    tables, staged = sold_tables(plain, lines), []
    orders = [(i, 5, "F", 10.0, datetime(1997, 6, 1), p) for i, p in enumerate(["4-NOT SPECIFIED", "5-LOW", "1-URGENT", None], 1)]
    tables.orders = plain.createDataFrame(orders, tables.orders.schema)
    lake = roles.staging(tables, lambda df: staged.append(df) or df)
    assert not [f.name for f in staged[1].schema.fields if f.dataType.simpleString() == "string"]
    assert {name: [r.orderid for r in lake[name].collect()] for name in ("shopeeorderdetails", "tiktokorderdetails", "nhanhvnorderdetails")} == {
        "shopeeorderdetails": ["S1"], "tiktokorderdetails": ["K2"], "nhanhvnorderdetails": ["N3"]}
    assert sorted(r.delivery_orderid for r in lake["returnedorders_scan"].collect()) == ["ST1", "T2", "T3", "T4", "T5"]


def test_rows_of_ordered_texts_are_shuffled_once(plain):
    """they were shuffled for the join with the large keys, then as texts by key."""
    rows = plain.range(60).select(F.when(F.col("id") % 4 > 0, F.concat(F.lit("k"), F.col("id") % 4)).alias("k"), F.when(F.col("id") % 8 < 6, F.col("id") % 2).alias("n"), "id")
    few = aggregates.ordered_text(rows, ["k", "n"], {"ids": F.col("id")}, [F.col("id")])
    assert len([e for e in exchanges(few) if re.fullmatch(r"k#\d+, n#\d+L?, 4", e)]) == 1  # pieces of large keys; no rows of small ones
    want = {}
    for r in rows.orderBy("id").collect():
        want.setdefault((r.k, r.n), []).append(str(r.id))
    for chunk in (10_000, 8, 3):  # all small, some large, all large; keys with NULL are keys
        out = aggregates.ordered_text(rows, ["k", "n"], {"ids": F.col("id")}, [F.col("id")], chunk=chunk).collect()
        assert {(r.k, r.n): r.ids for r in out} == {k: ",".join(v) for k, v in want.items()} and len(out) == len(want)


def test_lines_of_other_months_are_not_shuffled_by_parcel(plain, monkeypatch):
    """all lines were shuffled by parcel and by order again before the report picked its month."""
    june, may = datetime(1997, 6, 30, 23), datetime(1997, 5, 31, 23)
    fact = plain.range(40).select(
        F.when(F.col("id") < 38, (F.col("id") % 10).cast("string")).alias("orderid"), (F.col("id") % 4).cast("string").alias("deliveryid"),
        *[F.lit(1.4).cast("decimal(20,4)").alias(c) for c in ("shippingfee", "cod_collected_allquantity")]).repartition("orderid")
    orders = plain.createDataFrame([("1", june), ("1", june), ("2", may), ("3", None), ("4", datetime(1997, 7, 1)), ("5", datetime(1997, 6, 1)), (None, june)],
                                   "orderid string, createdat timestamp_ntz")
    parcels = plain.createDataFrame([("1", "GHN", "tk1"), ("3", None, None)], "trackingnumber string, courier string, courieraccount string")
    built = {"fact_orderdetails": fact, "dim_order": orders, "dim_delivery": parcels}
    monkeypatch.setattr(warehouse, "_built", lambda t: built)
    found = QUERIES["report_shipping_by_courier"](plain, "")
    whole = reports.run_report(plain, built, reports.SHIPPING_BY_COURIER, {"year": 1997, "month": 6})
    steps = found._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = {name: next(i for i, s in enumerate(steps) if name in s) for name in ("LeftSemi", "hashpartitioning(deliveryid#")}
    assert depth["LeftSemi"] > depth["hashpartitioning(deliveryid#"]  # picked below the shuffle by parcel
    assert sorted(found.collect(), key=str) == sorted(whole.withColumns({c: F.round(F.col(c).cast("double")).cast("bigint") for c in ("shippingfee", "cod")}).collect(), key=str)
    assert {r.courier: (r.n_parcels, r.shippingfee) for r in found.collect()} == {"GHN": (1, 8), None: (1, 8)}
