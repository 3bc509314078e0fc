"""Repair of conversation structure: the cheapest edits that make the roles of a conversation `(system)? (user assistant)+`, or leave nothing.

A conversation is read row by row by a Viterbi search over four states: nothing yet, after a system, user or assistant row. Survivors, the
cheapest way into each state, are leaves of a tree of backpointers; each node counts what refers to it, so that dead ways are freed, and the edits up to
the ancestor that all survivors share are emitted at once. Ways of equal cost are told apart by their complete unresolved edits, the
letters since that ancestor, and the least in ASCII order survives. A survivor that another one can replace at less cost, whatever follows, goes. Inserts stand in front of a row's letter (or at the very end), so two ways over the same rows
into different states have texts of which neither begins the other, and their order never changes later.

Rows are sorted by conversation and turn over range partitions. A conversation that lies within one partition and SEGMENT_ROWS rows and
SEGMENT_CHARS characters is repaired where it is read. Others, as long as they may be, are cut into segments: rows seen in an earlier segment are found by a join
on row digests; each segment is searched from each of the four states; one pass from the last segment to the first sums up the costs to go, and one from the
first to the last picks the cheapest way and adds the segment's lines to the digest. Both passes stream over sorted segments and hold one at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.tables import staging

SEGMENT_ROWS = 1024
SEGMENT_CHARS = 1 << 20
COMPARED = 256  # characters of a text that decide on its partition, among rows of one conversation, turn and role
KEPT = 1 << 14  # searches of short conversations that are remembered
WORD = re.compile(r"[^\x20\x09-\x0D]")
STARTED, SYSTEM, USER, ASSISTANT = range(4)
STATES = (STARTED, SYSTEM, USER, ASSISTANT)
DELETE, INSERT, REROLE, CUT = 4, 3, 3, 3
FAR = 1 << 60
# What it costs at most to go on from the second state as one could from the first: inserts, and a system row deleted that could have been kept.
BRIDGE = {
    (STARTED, ASSISTANT): DELETE, (STARTED, USER): INSERT + DELETE, (SYSTEM, STARTED): 0, (SYSTEM, ASSISTANT): 0, (SYSTEM, USER): INSERT,
    (USER, STARTED): INSERT, (USER, SYSTEM): INSERT, (USER, ASSISTANT): INSERT, (ASSISTANT, STARTED): 0, (ASSISTANT, SYSTEM): 2 * INSERT, (ASSISTANT, USER): INSERT,
}
CLOSING = {STARTED: (0, ""), SYSTEM: (2 * INSERT, "II"), USER: (INSERT, "I"), ASSISTANT: (0, "")}


def _after(state: int, initial: str) -> int | None:
    """The state that a row of this initial leads to, None if it may not follow."""
    if initial == "s":
        return SYSTEM if state == STARTED else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


def _next_role(state: int) -> tuple[str, int]:
    return ("assistant", ASSISTANT) if state == USER else ("user", USER)


def _moves(code: str, state: int) -> list[tuple[int, int, str]]:
    """(state, cost, letters) of the best ways over one row, with inserts in front of it, into each state.

    code: the row's initial, `x` for other roles, in upper case if its text is cut off; `d` if it has to go."""
    best: dict[int, tuple[int, str]] = {}
    at, cost, letters = state, 0, ""
    for _ in range(3):
        ways = [(at, DELETE, "D")]
        if code != "d":
            add = CUT if code.isupper() else 0
            ways.append((_next_role(at)[1], REROLE + add, "R"))
            kept = _after(at, code.lower())
            if kept is not None:
                ways.append((kept, add, "K"))
        for end, more, letter in ways:
            best[end] = min(best.get(end, (FAR, "")), (cost + more, letters + letter))
        at, cost, letters = _next_role(at)[1], cost + INSERT, letters + "I"
    return [(end, c, text) for end, (c, text) in sorted(best.items())]


MOVES = {(code, state): _moves(code, state) for code in "suaxSUAXd" for state in STATES}


class Survivors:
    """The cheapest way from one state into each state over the rows pushed so far."""

    def __init__(self, start: int = STARTED):
        self.root = [None, "", 1]  # parent, letters, what refers to it
        self.leaf = {start: self.root}
        self.cost = {start: 0}
        self.emitted: list[str] = []
        self.pushed = 0

    def _unresolved(self, node: list, above: list) -> str:
        letters = []
        while node is not above:
            letters.append(node[1])
            node = node[0]
        return "".join(reversed(letters))

    def _less(self, way: tuple, other: tuple) -> bool:
        """Of two ways of equal cost, given as (state, letters of this row)."""
        if way[0] == other[0]:
            return way[1] < other[1]
        return self._unresolved(self.leaf[way[0]], self.root) + way[1] < self._unresolved(self.leaf[other[0]], self.root) + other[1]

    def push(self, code: str) -> None:
        best: dict[int, tuple[int, tuple]] = {}
        for state, cost in self.cost.items():
            for end, more, letters in MOVES[code, state]:
                found = best.get(end)
                if found is None or cost + more < found[0] or (cost + more == found[0] and self._less((state, letters), found[1])):
                    best[end] = (cost + more, (state, letters))
        # a survivor that costs more than another with the bridge to it is on no cheapest way
        best = {end: way for end, way in best.items() if all(way[0] <= other[0] + BRIDGE.get((end, at), FAR) for at, other in best.items())}
        leaves = {}
        for end, (_, (state, letters)) in best.items():
            self.leaf[state][2] += 1
            leaves[end] = [self.leaf[state], letters, 1]
        for node in self.leaf.values():
            self._free(node)
        self.leaf, self.cost = leaves, {end: cost for end, (cost, _) in best.items()}
        self.pushed += 1
        if self.pushed % 8 == 0:
            self._emit()

    def _free(self, node: list | None) -> None:
        node[2] -= 1
        while node[2] == 0 and node[0] is not None:
            node = node[0]
            node[2] -= 1

    def _emit(self) -> None:
        """Emit the letters up to the last node that all survivors descend from."""
        way, node = [], next(iter(self.leaf.values()))
        while node is not self.root:
            way.append(node)
            node = node[0]
        while way and self.root[2] == 1:  # one child, and no survivor itself
            self.root = way.pop()
            self.emitted.append(self.root[1])
            self.root[0], self.root[1] = None, ""

    def ways(self) -> dict[int, tuple[int, str]]:
        """(cost, letters) of the survivor in each state."""
        emitted = "".join(self.emitted)
        return {state: (self.cost[state], emitted + self._unresolved(leaf, self.root)) for state, leaf in self.leaf.items()}


def search(codes: str, start: int = STARTED) -> dict[int, tuple[int, str]]:
    survivors = Survivors(start)
    for code in codes:
        survivors.push(code)
    return survivors.ways()


@lru_cache(maxsize=KEPT)
def closed(codes: str) -> tuple[int, str]:
    """Cost and letters of the cheapest edits of a whole conversation, the ASCII-least of them."""
    ways = search(codes)
    return min((cost + CLOSING[state][0], letters + CLOSING[state][1]) for state, (cost, letters) in ways.items())


def repaired(letters: str, roles: list[str], texts: list[str], state: int = STARTED) -> tuple[list[str], int]:
    """The lines that the edits leave, and the state after them."""
    lines, row = [], 0
    for letter in letters:
        if letter == "I":
            role, state = _next_role(state)
            lines.append(f"{role}:")
            continue
        if letter == "K":
            state = _after(state, roles[row][:1])
            lines.append(f"{roles[row]}:{texts[row]}")
        elif letter == "R":
            role, state = _next_role(state)
            lines.append(f"{role}:{texts[row]}")
        row += 1
    return lines, state


def faults(turns: list, roles: list[str], texts: list[str], before: set[bytes] = frozenset()) -> tuple[str, int, int, int]:
    """The rows' codes, and how many are blank, duplicate and truncated; before: digests of rows that stand earlier."""
    codes, seen, counts = [], set(before), {"blank": 0, "duplicate": 0, "truncated": 0}
    for role, text in zip(roles, texts):
        initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
        key, last = digest(role, text), None
        for last in reversed(text):  # the last character that is no blank
            if WORD.match(last):
                break
        else:
            last = None
        if last is None:
            counts["blank"] += 1
            codes.append("d")
        elif key in seen:
            counts["duplicate"] += 1
            codes.append("d")
        elif last not in ".!?":
            counts["truncated"] += 1
            codes.append(initial.upper())
        else:
            codes.append(initial)
        seen.add(key)
    return "".join(codes), counts["blank"], counts["duplicate"], counts["truncated"]


def digest(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)}:{role}:{text}".encode(), digest_size=16).digest()


def illegal_pairs(roles: list[str]) -> int:
    return sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))


def gaps(turns: Iterable) -> int:
    known = {t for t in turns if t is not None}
    return max(known) - min(known) + 1 - len(known) if known else 0


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, gone) after damage by crc32(conv_id:turn) % 20; null cells are one space. Dropped rows stay, marked as gone."""
    blank = F.lit(" ")
    name = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(name.cast("binary")) % 20
    text = F.coalesce("text", blank)
    role = F.when(kind == 4, F.lit("user")).otherwise(F.coalesce("role", blank))
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    times = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (kind == 0).alias("gone"), times.alias("copy_"))


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
NAMES = [f.split()[0] for f in RESULT.split(", ")]


def _sha(lines: list[str]) -> str:
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def _whole(turns: list, roles: list[str], texts: list[str]) -> tuple:
    codes, blank, duplicate, truncated = faults(turns, roles, texts)
    cost, audit = closed(codes) if len(codes) <= 64 else closed.__wrapped__(codes)
    return gaps(turns), blank, duplicate, truncated, illegal_pairs(roles), cost, audit, _sha(repaired(audit, roles, texts)[0])


def _segments(batches: Iterator[pa.RecordBatch], part: int, rows: int, chars: int) -> Iterator[tuple]:
    """(conv_id, place, whole, turns, roles, texts) of the runs of rows of one conversation, cut where they get too long.

    whole: it holds all rows of the conversation, as rows of others stand on both sides."""
    held, size, place, cut, first = None, 0, 0, False, True
    for batch in batches:
        for conv, turn, role, text, gone in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone"))):
            if held is None or conv != held[0]:
                if held is not None:
                    yield (*held[:1], part + place, not cut and not first, *held[1:])
                    place, first = place + 1, False
                held, size, cut = (conv, [], [], []), 0, False
            elif len(held[1]) >= rows or size >= chars:
                yield (*held[:1], part + place, False, *held[1:])
                held, size, place, cut = (conv, [], [], []), 0, place + 1, True
            if not gone:
                held[1].append(turn)
                held[2].append(role)
                held[3].append(text)
                size += len(role) + len(text)
    if held is not None:
        yield (*held[:1], part + place, False, *held[1:])


def _batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 1024, chars: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += sum(len(c) if isinstance(c, (str, bytes)) else sum(map(len, c)) if isinstance(c, list) and c and isinstance(c[0], (str, bytes)) else 8 for c in row)
        if len(held) >= size or weight >= chars:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _arrow(df_schema: str, conv: pa.DataType) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
             "array<binary>": pa.list_(pa.binary())}
    return pa.schema([("conv_id", conv), *((n, kinds[k]) for n, k in (f.split() for f in df_schema.split(", ")))])


PACKED = f"whole boolean, place long, turns array<long>, roles array<string>, texts array<string>, {RESULT}"
SEARCHED = "place long, blank long, duplicate long, truncated long, starts array<long>, ends array<long>, costs array<long>, ways array<string>"


def repair(rows: DataFrame, *, segment_rows: int = SEGMENT_ROWS, segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """One row per conv_id of `rows` (conv_id, turn, role, text; gone: the row only names its conversation): conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256.

    Rows are taken by turn, nulls first; rows of one turn by role and text. role and text are not null, turn may be, and so may conv_id, whose rows are one
    conversation. A conversation without rows gets zeros, an empty audit and the digest of the empty string. An empty table gives an empty result.
    """
    spark = rows.sparkSession
    schema = rows.schema
    conv_type = f"conv_id {schema['conv_id'].dataType.simpleString()}"
    order = ["conv_id", "turn", "role", "text"]
    shown = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", F.col("gone"))
    # rows that are equal in all that is compared may be parted, if that is their whole text
    draw = F.when(F.length("text") <= COMPARED, F.rand(7))
    sorted_ = shown.withColumn("draw_", draw).repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, COMPARED), "draw_").sortWithinPartitions(*order)
    sorted_ = sorted_.drop("draw_")
    stage, kept = staging(spark), staging(spark)

    def pack(batches):
        batches = iter(batches)
        head = next(batches, None)
        if head is None:
            return
        part, out = head.column("part_")[0].as_py() << 33, _arrow(PACKED, head.schema.field("conv_id").type)

        def packed():
            for conv, place, whole, turns, roles, texts in _segments(_chain(head, batches), part, segment_rows, segment_chars):
                yield (conv, True, place, None, None, None, *_whole(turns, roles, texts)) if whole else (conv, False, place, turns, roles, texts, *[None] * 8)

        yield from _batches(packed(), out)

    packed = kept(sorted_.withColumn("part_", F.spark_partition_id().cast("long")).mapInArrow(pack, f"{conv_type}, {PACKED}"))
    done = packed.filter("whole").select("conv_id", *NAMES)
    parts = packed.filter("not whole").select("conv_id", "place", "turns", "roles", "texts")
    with stage:
        return done.unionByName(kept(_across(parts, stage, conv_type)))


def _chain(head, batches):
    yield head
    yield from batches


def _across(parts: DataFrame, stage, conv_type: str) -> DataFrame:
    """The result of conversations that lie in several segments (conv_id, place, turns, roles, texts)."""
    def keys(batches):
        for batch in batches:
            found = [list({digest(r, t) for r, t in zip(roles, texts)}) for roles, texts in zip(batch.column("roles").to_pylist(), batch.column("texts").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("place"), pa.array(found, pa.list_(pa.binary()))], names=["conv_id", "place", "keys"])

    heads = stage(parts.select("conv_id", "place", "roles", "texts").mapInArrow(keys, f"{conv_type}, place long, keys array<binary>"))
    heads = heads.select("conv_id", "place", F.explode("keys").alias("key"))
    first = heads.groupBy("conv_id", "key").agg(F.min("place").alias("first"), F.count("*").alias("n")).filter("n > 1").select(
        F.col("conv_id").alias("conv_"), F.col("key").alias("key_"), "first")
    again = heads.join(first, F.col("conv_id").eqNullSafe(F.col("conv_")) & (F.col("key") == F.col("key_")) & (F.col("place") > F.col("first")))
    again = again.groupBy(F.col("place").alias("place_")).agg(F.collect_list("key").alias("before"))  # keys of one segment
    coded = parts.join(again, F.col("place") == F.col("place_"), "left").select("conv_id", "place", "turns", "roles", "texts", "before")

    def searched(batches):
        for batch in batches:
            out = []
            for conv, place, turns, roles, texts, before in zip(*(c.to_pylist() for c in batch.columns)):
                codes, blank, duplicate, truncated = faults(turns, roles, texts, set(before or ()))
                ways = [(start, end, *way) for start in STATES for end, way in search(codes, start).items()]
                out.append((conv, place, blank, duplicate, truncated, *map(list, zip(*ways))))
            yield from _batches(out, _arrow(SEARCHED, batch.schema.field("conv_id").type))

    ways = stage(coded.mapInArrow(searched, f"{conv_type}, {SEARCHED}"))

    def to_go(batches):
        held, go = None, {}
        for batch in batches:
            places, after = [], []
            for conv, place, starts, ends, costs in zip(*(c.to_pylist() for c in batch.columns)):
                if held is None or conv != held[0]:
                    held, go = (conv,), {s: CLOSING[s][0] for s in STATES}
                places.append(place)
                after.append([go[s] for s in STATES])
                cheapest = dict.fromkeys(STATES, FAR)
                for start, end, cost in zip(starts, ends, costs):
                    cheapest[start] = min(cheapest[start], cost + go[end])
                go = cheapest
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(after, pa.list_(pa.int64()))], names=["place_", "to_go"])

    back = ways.select("conv_id", "place", "starts", "ends", "costs").repartition("conv_id").sortWithinPartitions(F.col("conv_id"), F.col("place").desc())
    back = stage(back.mapInArrow(to_go, "place_ long, to_go array<long>"))
    ways = ways.withColumnRenamed("place", "place_").join(back, "place_").drop("conv_id")
    ready = parts.join(ways, F.col("place") == F.col("place_")).drop("place_")
    columns = ["conv_id", "place", "turns", "roles", "texts", "blank", "duplicate", "truncated", "starts", "ends", "costs", "ways", "to_go"]

    def follow(batches):
        def results():
            run = None
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    if run is None or row[0] != run.conv:
                        if run is not None:
                            yield run.result()
                        run = _Run(row[0])
                    run.add(*row[2:])
            if run is not None:
                yield run.result()

        batches = iter(batches)
        head = next(batches, None)
        if head is not None:
            batches = _chain(head, batches)
            yield from _batches(results(), _arrow(RESULT, head.schema.field("conv_id").type))

    return ready.select(*columns).repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(follow, f"{conv_type}, {RESULT}")


class _Run:
    """One conversation, segment by segment: the cheapest way picked so far and the digest of its lines."""

    def __init__(self, conv):
        self.conv, self.state, self.cost, self.audit = conv, STARTED, 0, []
        self.counts = [0, 0, 0]
        self.least = self.last = None
        self.distinct, self.illegal, self.role = 0, 0, None
        self.sha, self.empty = hashlib.sha256(), True

    def _lines(self, lines: list[str]) -> None:
        if lines:
            self.sha.update(("" if self.empty else "\n").encode() + "\n".join(lines).encode())
            self.empty = False

    def add(self, turns, roles, texts, blank, duplicate, truncated, starts, ends, costs, ways, to_go) -> None:
        self.counts = [a + b for a, b in zip(self.counts, (blank, duplicate, truncated))]
        for turn in turns:  # sorted
            if turn is not None and turn != self.last:
                self.least = turn if self.least is None else self.least
                self.last, self.distinct = turn, self.distinct + 1
        self.illegal += illegal_pairs([*([] if self.role is None else [self.role]), *roles])
        self.role = roles[-1] if roles else self.role
        _, way, cost, end = min((c + to_go[e], w, c, e) for s, e, c, w in zip(starts, ends, costs, ways) if s == self.state)
        self._lines(repaired(way, roles, texts, self.state)[0])
        self.state, self.cost = end, self.cost + cost
        self.audit.append(way)

    def result(self) -> tuple:
        cost, closing = CLOSING[self.state]
        self._lines(repaired(closing, [], [], self.state)[0])
        holes = 0 if self.least is None else self.last - self.least + 1 - self.distinct
        return (self.conv, holes, *self.counts, self.illegal, self.cost + cost, "".join([*self.audit, closing]), self.sha.hexdigest())


def structure(conversations: DataFrame, **options) -> DataFrame:
    """Damages the rows of `conversations` (conv_id, turn, role, text) and repairs them; see damaged and repair.

    Null cells are one space, in the name that decides the damage too; a null turn stays null in the order and in gaps. Other columns are not read.
    """
    return repair(damaged(conversations), **options)
