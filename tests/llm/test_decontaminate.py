"""Verbatim, re-parameterised and clean passages; canonical forms; odd rows."""

import pytest
from pyspark.sql import functions as F

from orderloom.llm.decontaminate import canonical, leaks, without_leaks, words

ITEM = "A train leaves Paris at 9 and travels 240 km in 3 hours. How far does the train from Paris get in 5 hours if it keeps its speed?"
OTHER = "The committee of Berlin met on four days of the week and wrote down what each of its members had said about the old harbour."


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, ITEM), (2, OTHER), (3, None), (4, ""), (5, "Short item of five words"), (1, ITEM)], "item_id long, text string")


def found(docs, items):
    return {(r.doc_id, r.item_id): r for r in leaks(docs, items).collect()}


def test_canonical_forms(spark):
    df = spark.createDataFrame([("He ran 5km, then 12.5 Miles (with Anna). Then 3rd; \"Bob\" won £4 two x1",)], "text string")
    got = df.select(canonical(words(F.col("text"))).alias("c")).first().c
    assert got == ["he", "ran", "<qty>", "then", "<num>", "<unit>", "with", "<name>", "then", "<num>", "<name>", "won", "£4", "<num>", "x1"]


def test_leaks(docs_of, items, text_of):
    filler = text_of(1, 50)
    other_numbers = ITEM.replace("240", "360").replace("Paris", "Rome").replace("9", "7")
    broken = ITEM.replace("from Paris", "from Rome")  # the one name is mapped to two: only windows with the second one are lost
    docs = docs_of([
        (10, f"{filler} {ITEM} {filler}"), (11, f"{filler}\n{other_numbers}\n{filler}"), (12, f"{filler} {broken} {filler}"), (13, filler), (None, None), (14, ""),
        (15, " ".join(ITEM.split()[:12]) + " " + filler), (16, f"{text_of(3, 20_000)} {OTHER.upper().lower()} {text_of(4, 20_000)}"), (17, "short item of five words"),
        (18, "Some short item of five words here"), (None, ITEM), (19, ITEM), (19, ITEM), (20, f"{ITEM} {OTHER}"), (21, " ".join(["4 km 5 kg 6 h 7 m"] * 30)),
    ]).selectExpr("*", "doc_id AS item_id", "text AS raw", "n_chars AS pos")
    got = found(docs, items)
    assert set(got) == {(10, 1), (11, 1), (12, 1), (16, 2), (17, 5), (18, 5), (None, 1), (19, 1), (20, 1), (20, 2)}
    assert not got[10, 1].reparametrised and got[11, 1].reparametrised
    assert got[19, 1].coverage == 1.0 and got[12, 1].n_matched == got[12, 1].n_windows - 8 and got[12, 1].reparametrised is False
    kept = without_leaks(docs, items)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["13", "None", "14", "15", "21"])


def test_empty_tables(docs_of, items):
    assert found(docs_of([]), items) == {}
    docs = docs_of([(1, ITEM)])
    assert found(docs, items.filter("false")) == {}
    assert without_leaks(docs, items.filter("false")).count() == 1


def test_shuffled_join_finds_the_same(docs_of, items, text_of, monkeypatch):
    from orderloom.llm import decontaminate

    docs = docs_of([(i, f"{text_of(i, 30)} {ITEM if i % 3 else ''} {text_of(i + 99, 30)}") for i in range(30)])
    few = set(found(docs, items))
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert set(found(docs, items)) == few == {(i, 1) for i in range(30) if i % 3}


def test_no_python(docs_of, items):
    plan = leaks(docs_of([(1, ITEM)]), items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_values_that_coincide_and_single_changes(docs_of, spark):
    item = "Ann has 5 red apples and gives 3 of them to her old friend who eats all of them at once before noon."
    long = "The river was 7 wide where the old mill stood. " + " ".join(f"part{i} of the tale" for i in range(20)) + " and then the water was 7 deep at the bridge."
    items = spark.createDataFrame([(1, item), (2, long)], "item_id long, text string")
    docs = docs_of([(1, item.replace("5", "4").replace("3", "4")), (2, long.replace("7 deep", "8 deep")), (3, "nothing of the kind")])
    got = found(docs, items)
    assert set(got) == {(1, 1), (2, 2)} and got[1, 1].reparametrised


def test_items_of_placeholders_only(docs_of, spark):
    items = spark.createDataFrame([(1, "1 + 2 3 4 5 6 7 8 9 10 11 12"), (2, "See Anna Bob Carl Dora Emil Fritz Gerd Hans Ida")], "item_id long, text string")
    docs = docs_of([(1, "so 1 + 2 3 4 5 6 7 8 9 10 11 12 it is"), (2, "I see Anna Bob Carl Dora Emil Fritz Gerd Hans Ida"), (3, "so 12 + 11 10 9 8 7 6 5 4 3 2 1 it is"),
                    (4, "See Kurt Lena Mia Nora Otto Paul Rita Sara Tom")])
    assert set(found(docs, items)) == {(1, 1), (2, 2)}


def test_other_case(docs_of, spark, items, text_of):
    names = "When Anna went to town with Bob the men of Carl saw how Dora ran off with Emil and his dog."
    more = items.unionByName(spark.createDataFrame([(6, names), (7, "Short and plain words")], "item_id long, text string"))
    docs = docs_of([(1, ITEM.upper()), (2, OTHER.title()), (3, names.lower()), (4, f"{text_of(1, 30)} {names.upper()}"), (5, "say Short and plain words")])
    assert set(found(docs, more)) == {(1, 1), (2, 2), (3, 6), (4, 6), (5, 7)}


def test_part_of_a_long_item(docs_of, spark, text_of):
    long = text_of(7, 300)
    items = spark.createDataFrame([(1, long)], "item_id long, text string")
    docs = docs_of([(1, f"{text_of(8, 40)} {' '.join(long.split()[100:113])} {text_of(9, 40)}"), (2, f"{text_of(8, 40)} {' '.join(long.split()[100:112])} {text_of(9, 40)}")])
    got = found(docs, items)
    assert set(got) == {(1, 1)} and got[1, 1].run_words == 13 and got[1, 1].coverage < 0.1


def test_texts_under_one_id_stand_alone(docs_of, spark, text_of):
    items = spark.createDataFrame([(1, text_of(i, 40)) for i in range(3)], "item_id long, text string")
    got = found(docs_of([(5, text_of(1, 40))]), items)
    assert set(got) == {(5, 1)} and got[5, 1].coverage == 1.0 and got[5, 1].n_windows == 33


def test_sql_on_rows_that_tell_the_rules_apart(spark, docs_of, text_of, tmp_path):
    """Copies verbatim, with slots changed consistently, by majority and without one, in other case, in part, of items of all kinds."""
    from oracle import compare
    from orderloom.llm.queries import QUERIES, SQL

    long = "The river was 7 wide where the old mill stood. " + " ".join(f"part{i} of the tale" for i in range(20)) + " and then the water was 7 deep at the bridge."
    numbers = "1 + 2 3 4 5 6 7 8 9 10 11 12"
    items = [(1, ITEM), (2, OTHER), (3, None), (4, ""), (5, "Short item of five words"), (1, ITEM), (6, long), (7, numbers), (8, text_of(1, 40)), (8, text_of(2, 40)), (None, text_of(3, 40))]
    texts = [ITEM, OTHER, long, numbers, text_of(1, 40), text_of(3, 40), ITEM.upper(), OTHER.title(), ITEM.replace("Paris", "Rome"), ITEM.replace("from Paris", "from Rome"),
             long.replace("7 deep", "8 deep"), long.replace("7", "9"), ITEM.replace("9", "3"), " ".join(ITEM.split()[:12]), " ".join(ITEM.split()[:13]), " ".join(long.split()[20:33]),
             " ".join(long.split()[20:32]), "2 + 1 4 3 6 5 8 7 10 9 12 11", "short item of five words", f"{ITEM} {ITEM.replace('240', '250')}", "", None, "£4 \u00c9mile 5km"]
    docs = [(i, t if t is None or i % 2 else f"{text_of(i, 30)} {t} {text_of(i + 50, 30)}") for i, t in enumerate(texts)] + [(None, ITEM), (0, texts[0]), (0, texts[0])]
    docs_of(docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    import duckdb
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    ok, text = compare(spark, QUERIES["op10_decontamination"], SQL["op10_decontamination"], str(tmp_path), con)
    assert ok, text
    assert int(text.split()[0]) >= 15
