"""One row per outcome rule, boundaries and unknown values."""

import pytest
from pyspark.sql import functions as F

from orderloom.operators import outcome as o

# parentsource, order status, return reason, courier, delivery status, paid, quantity, returned, total qty, total, label
OK, SELF = "GHN", "Tu Van Chuyen"
CASES = [
    ("di moi", "x", None, OK, "Da giao hang", 0.0, 2, 0, 2, 100000.0, "Hoan"),
    ("di moi", "x", None, OK, "Da giao hang", 30000.0, 2, 0, 2, 100000.0, "Hoan thu ship"),
    ("di moi", "x", None, OK, "Da tra hang", 100000.0, 2, 0, 2, 100000.0, "Hoan"),
    ("di moi", "x", None, OK, "Ky nhan chuyen hoan", 100001.0, 2, 0, 2, 100000.0, "Hoan"),
    ("di moi", "x", None, OK, "Da giao hang", 100000.0, 2, 0, 2, 100000.0, "Thanh cong"),
    ("di moi", "x", None, OK, "Da tra hang", 30001.0, 2, 0, 2, 100000.0, "Thanh cong"),
    ("di moi", "x", None, OK, "Da giao hang", 50000.0, 2, 2, 2, 100000.0, "Hoan"),
    ("di moi", "x", None, OK, "Da giao hang", 50000.0, 2, 1, 2, 100000.0, "Hoan mot phan"),
    ("bo sung", "x", None, OK, "Da tra hang", 0.0, 2, 2, 2, 100000.0, "Thanh cong"),
    ("bo sung", "x", None, OK, "Da tra hang", None, 2, 2, 2, 100000.0, "Thanh cong"),
    ("don doi", "x", None, OK, "Da giao hang", -1.0, 2, 0, 2, 100000.0, "Hoan"),
    ("don doi", "x", None, OK, "Da giao hang", 1.0, 2, 0, 2, 100000.0, "Hoan thu ship"),
    ("don doi", "x", None, OK, "Da giao hang", 30001.0, 2, 0, 2, 100000.0, "Hoan mot phan"),
    ("di moi", "x", None, OK, "Don huy", 0.0, 2, 0, 2, 100000.0, "Huy"),
    (None, "x", None, "SPX", "CANCELLED", 0.0, 2, 0, 2, 100000.0, "Huy"),
    ("di moi", "thanh cong", None, SELF, "x", 0.0, 2, 0, 2, 100000.0, "Hoan"),
    ("di moi", "da hoan", None, None, None, 30000.0, 2, 0, 2, 100000.0, "Hoan thu ship"),
    ("di moi", "thanh cong", None, SELF, "x", 100000.0, 2, 0, 2, 100000.0, "Thanh cong"),
    ("di moi", "thanh cong", None, SELF, "x", 99999.0, 2, 0, 2, 100000.0, "Thanh cong"),
    ("di moi", "thanh cong", None, SELF, "x", 99999.0, 2, 3, 2, 100000.0, "Hoan"),
    ("di moi", "thanh cong", None, SELF, "x", 99999.0, 2, 1, 2, 100000.0, "Hoan mot phan"),
    ("bo sung", "thanh cong", None, SELF, "x", 0.0, 2, 1, 2, 100000.0, "Thanh cong"),
    ("don doi", "thanh cong", None, SELF, "x", 0.0, 2, 1, 2, 100000.0, "Hoan"),
    ("don doi", "thanh cong", None, SELF, "x", 30000.0, 2, 1, 2, 100000.0, "Hoan thu ship"),
    ("don doi", "thanh cong", None, SELF, "x", 30001.0, 2, 1, 2, 100000.0, "Hoan thu ship"),
    ("di moi", "khach huy", None, None, None, 0.0, 2, 0, 2, 100000.0, "Huy"),
    (None, "he thong huy", None, SELF, None, 0.0, 2, 0, 2, 100000.0, "Huy"),
    (None, "x", None, "SPX", "COMPLETED", 0.0, 2, 2, 2, 100000.0, "Thanh cong"),
    (None, "x", "r", "SPX", "COMPLETED", 0.0, 1, 0, 1, 100000.0, "Hoan"),
    (None, "x", "r", "SPX", "COMPLETED", 0.0, 2, 2, 3, 100000.0, "Hoan"),
    (None, "x", "r", "SPX", "COMPLETED", 0.0, 2, 1, 3, 100000.0, "Hoan mot phan"),
    (None, "x", "r", "SPX", "COMPLETED", 0.0, 2, 0, 3, 100000.0, "Thanh cong"),
    (None, "CANCELLED", None, None, None, 0.0, 2, 0, 2, 100000.0, "Huy"),
    (None, "CANCELLED", "r", "SPX", "COMPLETED", 0.0, 0, 0, 0, 0.0, "Huy"),
    ("di moi", "x", None, OK, "Dang giao", 0.0, 2, 0, 2, 100000.0, "Pending"),
    # unknown values meet no condition
    (None, "x", None, OK, "Da giao hang", 0.0, 2, 0, 2, 100000.0, "Pending"),
    ("di moi", "x", None, OK, "Da giao hang", None, 2, 0, 2, 100000.0, "Pending"),
    ("di moi", "x", None, OK, "Da giao hang", 50000.0, 2, None, 2, 100000.0, "Pending"),
    ("di moi", "x", None, OK, "Da giao hang", 50000.0, None, 1, 2, 100000.0, "Pending"),
    ("di moi", "x", None, OK, "Da giao hang", 50000.0, 2, 0, 2, None, "Pending"),
    ("di moi", None, None, None, None, 0.0, 2, 0, 2, 100000.0, "Pending"),
    (None, None, "r", "SPX", "COMPLETED", 0.0, None, 1, 3, 100000.0, "Pending"),
]
SCHEMA = ("parentsource string, order_status string, return_reason string, courier string, delivery_status string, "
          "paid double, quantity long, returned long, total_quantity long, total_amount double, want string")


def test_every_rule(spark):
    df = spark.createDataFrame(CASES, SCHEMA)
    wrong = df.withColumn("got", o.outcome()).filter(~F.col("got").eqNullSafe(F.col("want"))).collect()
    assert not wrong


def test_rule_order_as_flat_cascade(spark):
    """The nested rules give the label of a flat first-match list on all combinations of their inputs."""
    axes = {
        "parentsource": ("string", [None, "don doi", "bo sung", "di moi"]),
        "order_status": ("string", [None, "thanh cong", "khach huy", "CANCELLED"]),
        "return_reason": ("string", [None, "r"]), "courier": ("string", [None, SELF, OK]),
        "delivery_status": ("string", [None, "Da tra hang", "Da giao hang", "Huy", "COMPLETED", "CANCELLED"]),
        "paid": ("double", [None, 0.0, 30000.0, 50000.0, 100000.0]), "returned": ("bigint", [None, 0, 1, 2]),
        "total_quantity": ("bigint", [1, 3]),
    }
    size, cols = 1, []
    for name, (kind, values) in axes.items():
        pick = F.floor(F.col("id") / size) % len(values)
        cols.append(F.get(F.array(*[F.lit(v).cast(kind) for v in values]), pick.cast("int")).alias(name))
        size *= len(values)
    df = spark.range(0, size, 1, 2).select(*cols)
    df = df.withColumns({"quantity": F.lit(2), "total_amount": F.lit(100000.0)}).withColumn("got", o.outcome())
    back, given = "delivery_status = 'Da tra hang'", "delivery_status = 'Da giao hang'"
    done = f"courier <> '{SELF}' AND ({back} OR {given})"
    own = f"(courier = '{SELF}' OR courier IS NULL) AND order_status = 'thanh cong'"
    ordinary, between = "parentsource NOT IN ('don doi', 'bo sung')", "paid > 30000 AND paid < total_amount"
    market = "parentsource IS NULL AND delivery_status = 'COMPLETED'"

    def goods(when, order):
        state = {"none": ("returned = 0", "Thanh cong"), "all": ("returned >= quantity", "Hoan"),
                 "some": ("returned > 0 AND returned < quantity", "Hoan mot phan")}
        return [(f"{when} AND {state[k][0]}", state[k][1]) for k in order]

    flat = [
        (f"{ordinary} AND {done} AND paid <= 0", "Hoan"),
        (f"{ordinary} AND {done} AND paid > 0 AND paid <= 30000", "Hoan thu ship"),
        (f"{ordinary} AND {done} AND {back} AND paid >= total_amount", "Hoan"),
        (f"{ordinary} AND {done} AND {given} AND paid >= total_amount", "Thanh cong"),
        *goods(f"{ordinary} AND {done} AND {between}", ("none", "all", "some")),
        (f"parentsource = 'bo sung' AND {done}", "Thanh cong"),
        (f"parentsource = 'don doi' AND {done} AND paid <= 0", "Hoan"),
        (f"parentsource = 'don doi' AND {done} AND paid > 0 AND paid <= 30000", "Hoan thu ship"),
        (f"parentsource = 'don doi' AND {done} AND paid > 30000", "Hoan mot phan"),
        (f"courier <> '{SELF}' AND delivery_status IN ('Huy', 'CANCELLED')", "Huy"),
        (f"{ordinary} AND {own} AND paid <= 0", "Hoan"),
        (f"{ordinary} AND {own} AND paid > 0 AND paid <= 30000", "Hoan thu ship"),
        (f"{ordinary} AND {own} AND paid >= total_amount", "Thanh cong"),
        *goods(f"{ordinary} AND {own} AND {between}", ("none", "all", "some")),
        (f"parentsource = 'bo sung' AND {own}", "Thanh cong"),
        (f"parentsource = 'don doi' AND {own} AND paid <= 0", "Hoan"),
        (f"parentsource = 'don doi' AND {own} AND paid > 0 AND paid <= 30000", "Hoan thu ship"),
        (f"parentsource = 'don doi' AND {own} AND paid > 30000", "Hoan thu ship"),
        (f"(courier = '{SELF}' OR courier IS NULL) AND order_status = 'khach huy'", "Huy"),
        (f"{market} AND return_reason IS NULL", "Thanh cong"),
        (f"{market} AND return_reason IS NOT NULL AND total_quantity = 1", "Hoan"),
        *goods(f"{market} AND return_reason IS NOT NULL AND total_quantity > 1", ("all", "some", "none")),
        ("parentsource IS NULL AND (order_status = 'CANCELLED' OR delivery_status = 'CANCELLED')", "Huy"),
    ]
    case = "CASE " + " ".join(f"WHEN {when} THEN '{label}'" for when, label in flat) + " ELSE 'Pending' END"
    assert len(flat) == 29
    assert size == 4 * 4 * 2 * 3 * 6 * 5 * 4 * 2
    assert df.filter(~F.expr(case).eqNullSafe(F.col("got"))).count() == 0


@pytest.mark.parametrize("status,quantity,returned,want", [
    ("Huy", 2, 0, 0.0), ("Hoan", 2, 0, 0.0), ("Pending", 2, 0, 0.0), ("Thanh cong", 2, 1, 170.0),
    ("Hoan thu ship", 2, 2, 170.0), ("Hoan mot phan", 3, 1, 200 - 20 * 2 / 3 - 10 * 2 / 3), ("Hoan mot phan", 2, 2, 0.0),
    ("Hoan mot phan", 0, 0, 0.0),
])
def test_success_value(spark, status, quantity, returned, want):
    df = spark.range(1).select(o.success_value(
        F.lit(status), F.lit(quantity), F.lit(100), F.lit(20.0), F.lit(10.0), F.lit(returned)).alias("v"))
    assert df.first().v == pytest.approx(want)


def test_paid(spark):
    df = spark.createDataFrame([(10.0, 0.0, 5.0), (10.0, 7.0, 5.0), (None, 0.0, 5.0)], "cod double, bank double, pre double")
    got = [r[0] for r in df.select(o.paid(F.col("cod"), F.col("bank"), F.col("pre"))).collect()]
    assert got == [15.0, 17.0, None]
