"""Exact links, components and link counts against brute force, through every path of the join."""

import glob
import random
import re
import time

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from orderloom.llm import blocks, jaccard_join, kernel
from orderloom.llm.jaccard_join import jaccard_links, one_per_group
from orderloom.llm.tables import staging
from orderloom.staged import FREES_SHUFFLES, Staged

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    near = [[i for i in range(len(rows)) if i != j and s and 100 * len(s & sets[i]) >= 75 * len(s | sets[i])] for j, s in enumerate(sets)]
    out = []
    for j, (doc_id, _) in enumerate(rows):
        seen, todo = {j}, [j]
        while todo:
            for i in near[todo.pop()]:
                if i not in seen:
                    seen.add(i)
                    todo.append(i)
        ids = [rows[i][0] for i in seen if rows[i][0] is not None]
        out.append((doc_id, len(sets[j]), min(ids) if ids else None, len(near[j])))
    return sorted(out, key=str)


def check(docs_of, rows, **options):
    got = [(r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in jaccard_links(docs_of(rows), **options).collect()]
    assert sorted(got, key=str) == brute(rows)


def edited(text, seed, edits):
    r, words = random.Random(seed), text.split()
    for _ in range(edits):
        words[r.randrange(len(words))] = f"x{r.randrange(10**6)}"
    return " ".join(words)


def families(text_of):
    """Groups of near copies with 0 to 4 edits in 100 words, chains, copies, and texts that share one passage."""
    rows = [(i, text_of(i, 80)) for i in range(30)]
    for g in range(6):
        base = text_of(1000 + g, 100)
        rows += [(100 + 20 * g + k, edited(base, g * 100 + k, k % 5)) for k in range(12)]
    passage = text_of(7777, 60)
    rows += [(400 + k, text_of(500 + k, 30) + " " + passage) for k in range(10)]
    rows += [(500 + k, rows[3][1]) for k in range(8)]
    return rows


EDGES = [(None, None), (2001, None), (2002, ""), (2003, " \t\n"), (2004, "one two"), (2005, "ONE two"), (2006, "one two three"), (2007, "a b c d e"), (2008, "a b c d e"), (2008, "a b c d e"),
         (None, "A B C D E"), (2009, "é ß  x y z q"), (2010, "é ß  x y z q"), (None, "only null here is a text"), (None, "only null here is a text")]


def test_families(docs_of, text_of):
    check(docs_of, families(text_of) + EDGES)


def test_many_blocks_and_buckets(docs_of, text_of):
    check(docs_of, families(text_of), block_bytes=4000, bucket_keys=500)


def test_voronoi_cells_split_and_dense_cells_dealt(docs_of, text_of, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CELL_POINTS", 8)
    monkeypatch.setattr(jaccard_join, "PIVOTS", 3)
    base = text_of(42, 60)
    rows = families(text_of) + [(900 + k, edited(base, 9000 + k, 1 + k % 3)) for k in range(60)]
    check(docs_of, rows)


def test_very_long_text(docs_of, text_of):
    long = text_of(5, 60_000, 10**6)
    check(docs_of, [(1, long), (2, edited(long, 1, 100)), (3, text_of(6, 50_000, 10**6))])


def test_empty_table(docs_of):
    assert jaccard_links(docs_of([])).collect() == []


@pytest.mark.parametrize("extra", ["key", "cell", "set_key"])
def test_one_per_group_keeps_columns(docs_of, text_of, extra):
    docs = docs_of(families(text_of) + EDGES).selectExpr("*", f"n_chars AS `{extra}`")
    kept = one_per_group(docs)
    assert kept.columns == docs.columns
    want = brute(families(text_of) + EDGES)
    components = {c for _, n, c, _ in want if n and c is not None}
    rows = kept.collect()
    got = [r.doc_id for r in rows if (r.text or "").split()]
    assert sorted(x for x in got if x is not None) == sorted(components)
    assert got.count(None) == 1  # the component without any id
    assert len(rows) - len(got) == 4  # without words


def staged_rows(monkeypatch, rows):
    """Has `rows` hold, for each intermediate table that is written, its columns and number of rows."""
    class Counted(Staged):
        def __call__(self, df, by=None):
            out = super().__call__(df, by)
            rows.append((out.columns, out.count()))
            return out

    monkeypatch.setattr(jaccard_join, "staging", lambda spark, **options: Counted(spark, **options))


def test_near_copies_are_not_replicated(docs_of, text_of, monkeypatch):
    """A group whose points all lie within 2 r of each other is too large for a cell: a split would send each point to each of its cells."""
    monkeypatch.setattr(jaccard_join, "CELL_POINTS", 32)
    base, written = text_of(42, 100), []
    rows = [(k, edited(base, k, 1 + k % 5)) for k in range(150)]
    staged_rows(monkeypatch, written)
    check(docs_of, rows)
    assert max(n for columns, n in written if "shingles" in columns) <= len(rows)


def test_cells_that_lie_apart_are_split(docs_of, text_of, monkeypatch):
    """Groups of one region with little in common: splits halve the comparisons, and each point stays in few cells."""
    monkeypatch.setattr(jaccard_join, "CELL_POINTS", 16)
    splits = []
    monkeypatch.setattr(jaccard_join, "_split", lambda made, f=jaccard_join._split: splits.append(made.count()) or f(made))
    bases = [text_of(100 + g, 100) for g in range(14)]
    rows = [(100 * g + k, edited(base, 100 * g + k, k % 3)) for g, base in enumerate(bases) for k in range(8)]
    # half of one group's text and half of the next one's: near neither, but their windows make one region of all
    rows += [(5000 + g, a[:len(a) // 2] + " " + b[:len(b) // 2]) for g, (a, b) in enumerate(zip(bases, bases[1:]))]
    check(docs_of, rows)
    assert splits and splits[0]


def test_a_block_gives_back_its_points(text_of):
    sets = [np.unique(np.random.default_rng(k % 5).integers(0, 2**63, 50 + k % 7).astype(np.uint64)) for k in range(40)] + [np.array([7], dtype=np.uint64)]
    rows = pa.table({"key": [f"{k:032x}" for k in range(41)], "shingles": [s.tobytes() for s in sets], "home": [k % 2 == 0 for k in range(41)]})
    block, shingles = jaccard_join._frozen(rows)
    back = jaccard_join._thawed(block, shingles)
    assert back.column("key").to_pylist() == rows.column("key").to_pylist() and back.column("home").to_pylist() == rows.column("home").to_pylist()
    assert [set(np.frombuffer(x, dtype=np.uint64).tolist()) for x in back.column("shingles").to_pylist()] == [set(s.tolist()) for s in sets]
    assert len(block) + len(shingles) < 0.5 * sum(s.nbytes for s in sets)


@pytest.mark.parametrize("buckets", [1, 7, 1000])
def test_requests_are_short(buckets):
    keys = np.unique(np.random.default_rng(3).integers(0, 2**64, 700 * buckets, dtype=np.uint64))
    counts = np.arange(1, len(keys) + 1) % 5 + 1
    asked = blocks.ask(1, 0, keys, counts, buckets, blocks.SHORT)
    sent = sum(map(len, asked.column("keys").to_pylist()))
    assert sent < 2.4 * len(keys)
    answer = blocks._answer(blocks.SHORT, lambda x: x)
    given = []
    for b in range(buckets):
        part = asked.filter(pc.equal(asked.column("bucket"), b))
        if part.num_rows:
            given.append(blocks._numbers(answer(part).column("counts")[0].as_py(), np.int64))
    given = np.concatenate(given)
    assert len(given) == len(keys) and (given >= counts).all()
    assert (given == counts).mean() > 0.99


def test_texts_are_packed_and_unpacked():
    texts = pa.array([None, "", "a", "é ß " * 1000, "x" * 100_000], pa.string())
    packed = kernel.packed(texts)
    assert kernel.unpacked(packed).to_pylist() == [None if t is None else t.encode() for t in texts.to_pylist()]
    assert sum(len(x.as_py() or b"") for x in packed) < 2000
    broken = pa.array([b"\xff\xfe one", b"two"], pa.binary())
    assert kernel.unpacked(kernel.packed(broken)) == broken


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(k).getName() for k in range(files.size()) if "shuffle_" in files.apply(k).getName()}


def test_shuffle_files_go_when_a_table_stands(spark):
    before = shuffle_files(spark)
    with staging(spark, frees=True) as stage:
        table = stage(spark.range(1000).repartition(7, "id"))
        deadline = time.time() + 20
        while shuffle_files(spark) - before and time.time() < deadline:
            time.sleep(0.2)
        assert not shuffle_files(spark) - before
        assert table.count() == 1000
    assert spark.conf.get(FREES_SHUFFLES, None) is None


def test_working_tables_are_dropped(spark, docs_of, text_of, monkeypatch):
    """Only what the result reads stays."""
    made = []
    monkeypatch.setattr(jaccard_join, "staging", lambda spark, **options: made.append(Staged(spark, **options)) or made[-1])
    links = jaccard_links(docs_of(families(text_of)))
    left = [p for stage in made for p in glob.glob(f"{stage.root.removeprefix('file:')}/*")]
    assert links.count() == len(families(text_of)) and len(left) == 2


def test_one_per_group_shuffles_rows_once(spark, docs_of, text_of):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = one_per_group(docs_of(families(text_of) + EDGES))
        plan = kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.split("MapInArrow")[0].count("Exchange ") == 1
