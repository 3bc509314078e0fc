"""Conversation repair against a plain search over whole strings."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from orderloom.llm import dialogue as d
from orderloom.llm.queries import QUERIES
from oracle import TESTDATA

SCHEMA = "conv_id long, turn long, role string, text string"


def edits(rows):
    """(cost, audit, lines) by a shortest-path search that keeps whole strings; rows: (role, text, fault)."""
    follow = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"": (0, "", ())}

    def spread(best):
        for _ in range(3):
            for state, (cost, audit, lines) in list(best.items()):
                for role in ("user", "assistant"):
                    end = follow.get((state, role[0]))
                    if end:
                        way = (cost + 3, audit + "I", (*lines, role + ":"))
                        best[end] = min(best.get(end, way), way)
        return best

    best = spread(best)
    for role, text, fault in rows:
        new = {}
        for state, (cost, audit, lines) in best.items():
            ways = [(state, cost + 4, audit + "D", lines)]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                for name, letter, price in ((role, "K", 0), ("user", "R", 3), ("assistant", "R", 3)):
                    end = follow.get((state, name[:1]))
                    if end:
                        ways.append((end, cost + price + more, audit + letter, (*lines, f"{name}:{text}")))
            for end, *way in ways:
                new[end] = min(new.get(end, tuple(way)), tuple(way))
        best = spread(new)
    return min(best[s] for s in ("", "a") if s in best)


def expected(rows):
    """The result per conv_id of rows (conv_id, turn, role, text)."""
    of = {}
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        held = of.setdefault(conv, [])
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        held += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, held in of.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marked, n = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in held:
            shown = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                n[fault] += 1
            marked.append((role, text, fault))
        turns = [t for t, _, _ in held if t is not None]
        cost, audit, lines = edits(marked)
        pairs = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(held, held[1:]))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, n["blank"], n["duplicate"], n["truncated"], pairs, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def got(df):
    rows = df.collect()
    assert df.columns == ["conv_id", *d.NAMES]
    found = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(found) == len(rows)
    return found


def random_rows(seed, convs, most):
    r = random.Random(seed)
    texts = ["Yes.", "No!", "cut off", " \t", "", "Why? ", "é.\n", "What", None]
    return [(c, None if r.random() < 0.1 else r.randrange(-3, most + 3), r.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]),
             r.choice(texts) if r.random() < 0.3 else f"text {r.randrange(10 * most)}.") for c in (*range(convs), None) for _ in range(r.randrange(1, most))]


@pytest.mark.parametrize("seed", range(40))
def test_search_finds_the_least_of_the_cheapest(seed):
    r = random.Random(seed)
    codes = "".join(r.choice("suaxSUAXd" if seed % 2 else "uaxxd") for _ in range(r.randrange(40)))
    names = {"s": "system", "u": "user", "a": "assistant", "x": "tool", "d": "user"}
    rows = [(names[c.lower()], "", "blank" if c == "d" else "truncated" if c.isupper() else None) for c in codes]
    cost, audit, lines = edits(rows)
    assert d.closed(codes) == (cost, audit)
    assert tuple(d.repaired(audit, [x[0] for x in rows], [x[1] for x in rows])[0]) == lines


def test_settled_edits_leave_the_tree():
    survivors = d.Survivors()
    for _ in range(5000):
        survivors.push("u")
        survivors.push("a")
    assert len(survivors.emitted) > 9900
    assert max(len(survivors._unresolved(leaf, survivors.root)) for leaf in survivors.leaf.values()) < 100


def test_unsettled_ties_are_compared_whole():
    codes = "x" * 301  # no role fits: the survivors share nothing but the start
    assert d.closed(codes) == edits([("tool", ".", None)] * 301)[:2]


@pytest.mark.parametrize("rows_", [4, 1024])
def test_repair_equals_plain_search(spark, rows_):
    data = random_rows(5, 60, 12) + [(1000, t, ("user", "assistant")[t % 2], f"line {t % 40}.") for t in range(300)]
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    assert got(d.structure(df, segment_rows=rows_)) == expected(data)


def test_long_texts_are_cut_by_size(spark):
    data = [(c, t, ("user", "assistant")[t % 2], f"{c} {t} " + "word " * 500 + ".") for c in range(3) for t in range(20)]
    assert got(d.structure(spark.createDataFrame(data, SCHEMA), segment_chars=4000)) == expected(data)


def test_repeated_rows_extra_columns_and_shuffled_input(spark):
    data = random_rows(9, 20, 8) * 2
    df = spark.createDataFrame(data, SCHEMA).withColumn("place", F.lit(1)).withColumn("whole", F.lit("x")).withColumn("gone", F.lit(True)).withColumn("part_", F.lit(2))
    assert got(d.structure(df.orderBy(F.rand(3)))) == expected(data)


def test_one_conversation_of_equal_rows(spark):
    data = [(1, None, "user", "same."), *[(1, 7, "user", "same.")] * 500]
    assert got(d.structure(spark.createDataFrame(data, SCHEMA), segment_rows=16)) == expected(data)


def test_conversations_without_rows(spark):
    gone = next((c, t) for c in range(1000) for t in range(1) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    assert got(d.structure(spark.createDataFrame([(*gone, "user", "x.")], SCHEMA)))[gone[0]] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got(d.structure(spark.createDataFrame([], SCHEMA))) == {}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_on_whole_table(spark, sf):
    data = [tuple(r) for r in spark.read.parquet(f"{TESTDATA}/{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op12_conversation_repair"](spark, f"{TESTDATA}/{sf}")) == expected(data)
