"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle import TESTDATA, compare, duck
from orderloom.plans.registry import QUERIES, SQL

SF = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    ok, text = compare(spark, entry.queries()[name], SQL[name], SF, con)
    assert ok, text


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql())
    df = entry.entry(spark)
    assert df.columns == ["orderid", "productid", "quantity", "return_quantity", "finalstatus"]
    assert df.count() > 0


def test_outcome_frames_reach_every_label(spark):
    labels = {r[0] for r in entry.entry(spark).select("finalstatus").distinct().collect()}
    assert labels == {"Thanh cong", "Hoan", "Hoan mot phan", "Hoan thu ship", "Huy", "Pending"}
