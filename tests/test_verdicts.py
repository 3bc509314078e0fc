"""Rejects, doubts, contracts and single bad files through a run."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

import landing
from orderloom.feeds import cash, couriers, sheets
from orderloom.operators import verdicts as v
from orderloom.plans import runner
from orderloom.sources.store import TableStore
from orderloom.staged import Staged

T1, T2 = datetime(2025, 1, 1), datetime(2025, 1, 2)
BANK = {"Ngày": "03/01/2024", "Số tiền bank": "100.000đ"}


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"), parts=2)


def run(store, tmp_path, step, source, at=T1, **params):
    return runner.run([step], store.spark, store, {step: [source]}, at, params)


def test_one_pass_parts_rows_by_verdict(spark, tmp_path):
    path = tmp_path / "in.parquet"
    spark.createDataFrame([(1, "a", "f1"), (2, None, "f1"), (3, "c", "f2"), (4, "dd", "f3")], "row_no long, `x (y)` string, source_file string").write.parquet(str(path))
    with Staged(spark) as stage:
        inspect = v.Inspection(stage, str(tmp_path / "rejects"), "feed", "a", T1)
        x = F.col("`x (y)`")
        kept = inspect(spark.read.parquet(str(path)), {"missing": x.isNull(), "long": F.length(x) > 1}, {"c": x == "c", "never": F.lit(None).cast("boolean")})
        for part in path.iterdir():
            part.unlink()  # nothing reads the rows a second time
        assert sorted(r.row_no for r in kept.collect()) == [1, 3] and kept.columns == ["row_no", "x (y)", "source_file"]
        assert inspect.found == {"missing": 1, "long": 1, "c": 1} and inspect.files == []
        by_file = inspect(kept, {"c": x == "c"}, by_file="source_file")
        assert [r.row_no for r in by_file.collect()] == [1] and inspect.files == ["f2"]
    bad = spark.read.option("basePath", str(tmp_path / "rejects")).parquet(str(tmp_path / "rejects"))
    assert sorted((r.row_no, r.source_file, list(r.reasons), r.feed) for r in bad.collect()) == [
        (2, "f1", ["missing"], "feed"), (3, "f2", ["c"], "feed"), (4, "f3", ["long"], "feed")]
    assert {r.cells for r in bad.filter("row_no = 4").collect()} == {'{"row_no":4,"x (y)":"dd","source_file":"f3"}'}


def test_rejected_transfers_stand_in_a_table(store, tmp_path):
    sheet = landing.sheet(tmp_path / "bank.csv", sheets.CUSTOMER_BANK, [
        {**BANK, "ID": "KB_1", "ID đơn hàng": "1"}, {**BANK, "ID": "KB1", "ID đơn hàng": "2"}, {**BANK, "ID": "", "ID đơn hàng": "3"}, {**BANK, "ID": "KB_4", "ID đơn hàng": " "}])
    for at in (T1, T1, T2):  # the same run again replaces its own rejects
        state = run(store, tmp_path, "customer_bank", {"sheet": sheet}, at)
        assert state == {"customer_bank/0": "ok"}
        assert state.found["customer_bank/0"] == {"ID is not KB_ and digits": 2}
    assert [r.bank_surrogateid for r in store.read("customerbanks").collect()] == ["KB_1"]
    bad = runner.read_rejects(store).collect()
    assert sorted((r.row_no, r.run) for r in bad) == [(2, "20250101T000000"), (2, "20250102T000000"), (3, "20250101T000000"), (3, "20250102T000000")]
    assert all('"ID đơn hàng"' in r.cells and r.feed == "customer_bank" for r in bad)


def test_doubtful_amounts_are_loaded_and_reported(store, tmp_path):
    parcels = landing.grid(tmp_path / "spx" / "p.csv", couriers.SPX_PARCELS, [
        {"Mã vận đơn": "X1", "Số tiền COD": "-", "Giá trị đơn hàng": "2999"}, {"Mã vận đơn": "X2", "Số tiền COD": "5000", "Phí vận chuyển thực tế": "2000000000"}], 3)
    state = run(store, tmp_path, "spx", {"account": "t", "parcels": parcels})
    assert state == {"spx/t": "ok"} and store.read("deliveryorders").count() == 2
    assert state.found["spx/t"] == {"Số tiền COD is no number": 1, "Giá trị đơn hàng is below 3000 or above 1000000000": 1,
                                    "Phí vận chuyển thực tế is below 3000 or above 1000000000": 1}


def test_repeated_notes_and_short_catalogues_are_reported(store, tmp_path):
    notes = landing.sheet(tmp_path / "n.csv", sheets.HANDLING_NOTES, [{"Mã vận đơn": "P1", "Ghi chú 1": "a"}, {"Mã vận đơn": "P1", "Ghi chú 1": "b"}, {"Mã vận đơn": "P2"}])
    state = run(store, tmp_path, "handling_notes", {"sheets": [notes]})
    assert state.found["handling_notes/0"] == {"parcel is noted more than once": 2}
    assert {r.delivery_orderid: r.handleteam_note1 for r in store.read("handle_deliveryorders").collect()} == {"P1": "b", "P2": None}
    catalogue = landing.sheet(tmp_path / "c.csv", sheets.CATALOGUE, [{"Mã SP": "MDU1000", "Giá nội bộ": "290k"}, {"Mã SP": "ao", "Giá nội bộ": "?"}])
    with pytest.warns(UserWarning, match="fewer than 2 valid rows"):
        state = run(store, tmp_path, "catalogue", {"sheet": catalogue, "minimum": 2})
    assert state.found["catalogue/0"] == {"no right sku": 1, "no right price": 1} and store.read("dim_product").count() == 0
    assert run(store, tmp_path, "catalogue", {"sheet": catalogue, "minimum": 1}) == {"catalogue/0": "ok"} and store.read("dim_product").count() == 2


@pytest.mark.parametrize("bad, reason", [
    ('1,"J2 torn\n2",300,a-20240131-0131\n', "the file cannot be read"), ("1,J2,12.5,a-20240131-0131\n", "Tiền thực nhận is not whole")])
def test_one_bad_file_of_three(store, tmp_path, bad, reason):
    line = {"Tiền thực nhận": "100", "Kỳ thanh toán": "a-20240131-0131"}
    landing.sheet(tmp_path / "jte" / "a.csv", cash.JTE_CASH, [{**line, "Mã vận đơn": "J1"}])
    landing.sheet(tmp_path / "jte" / "c.csv", cash.JTE_CASH, [{**line, "Mã vận đơn": "J3"}, {**line, "Mã vận đơn": "J4", "Kỳ thanh toán": "undated"}])
    (tmp_path / "jte" / "b.csv").write_text("row_no,Mã vận đơn,Tiền thực nhận,Kỳ thanh toán\n0,J0,100,a-20240131-0131\n" + bad, encoding="utf-8")
    state = run(store, tmp_path, "jte_cash", {"folder": str(tmp_path / "jte")})
    assert state == {"jte_cash/0": "ok"}
    assert sorted(r.delivery_orderid for r in store.read("delivery_reconciliation").collect()) == ["J1", "J3", "J4"]
    assert [f.rsplit("/", 1)[1] for f in state.files["jte_cash/0"]] == ["b.csv"]
    assert state.found["jte_cash/0"][reason] >= 1 and state.found["jte_cash/0"]["Kỳ thanh toán has no date, dated today"] >= 1


def test_bad_workbooks_beside_sound_ones(store, tmp_path):
    amount, folder, cells = cash.GHN_CASH[1], tmp_path / "ghn", {(8, 1): "COD_1", (9, 1): "05/01/2024"}
    landing.grid(folder / "a.csv", cash.GHN_CASH, [{"Mã đơn GHN": "NVS123456789", amount: "10"}, {"Mã đơn GHN": "odd", amount: "20"}], 20, cells)
    landing.grid(folder / "b.csv", ("Mã khác", amount), [{"Mã khác": "NVS2", amount: "10"}], 20, cells)
    landing.grid(folder / "c.csv", cash.GHN_CASH, [{"Mã đơn GHN": "NVS3", amount: "10"}], 20, {(8, 1): "X", (9, 1): "05/01/2024"})
    state = run(store, tmp_path, "ghn_cash", {"folder": str(folder)})
    assert state == {"ghn_cash/0": "ok"}
    assert sorted(r.delivery_orderid for r in store.read("delivery_reconciliation").collect()) == ["NVS123456789", "odd"]
    assert [f.rsplit("/", 1)[1] for f in state.files["ghn_cash/0"]] == ["b.csv", "c.csv"]
    assert state.found["ghn_cash/0"] == {"the file cannot be read": 1, "the session is no COD session": 1, "Mã đơn GHN has neither form of a parcel id": 3}


def test_contract_breaks_fail_the_feed(store, tmp_path):
    sheet = landing.sheet(tmp_path / "n.csv", sheets.HANDLING_NOTES, [{"Mã vận đơn": "P1", "Ghi chú 1": "x" * 256}])
    with pytest.warns(UserWarning, match="handle_deliveryorders.handleteam_note1 is longer than 255"):
        state = run(store, tmp_path, "handling_notes", {"sheets": [sheet]})
    assert state["handling_notes/0"].startswith("failed") and store.read("handle_deliveryorders").count() == 0
    sheet = landing.sheet(tmp_path / "s.csv", sheets.RETURN_SCANS, [{"Key": None, "NGÀY": "5", "THÁNG": "T1", "Mã vận đơn": "NVS1", "Mã SP": "A"}])
    with pytest.warns(UserWarning, match="returnedorders_scan.scan_surrogateid is missing"):
        assert run(store, tmp_path, "return_scans", {"sheet": sheet}, year=2024)["return_scans/0"].startswith("failed")


def test_dangling_references_are_counted(store):
    from orderloom.schemas import conform

    fact = store.spark.createDataFrame([("o1", "p1", "A", "d1"), ("o2", "p2", "B", None), ("o3", "p3", "A", "d9")], "orderid string, productid string, parentproductid string, deliveryid string")
    store.replace("dim_order", conform(store.spark.createDataFrame([("o1",), ("o2",)], "orderid string"), "dim_order"))
    store.replace("dim_product", conform(store.spark.createDataFrame([("A",)], "productid string"), "dim_product"))
    assert runner.star_problems(store, conform(fact, "fact_orderdetails")) == {
        "orderid not in dim_order": 1, "parentproductid not in dim_product": 1, "deliveryid not in dim_delivery": 2}
