"""Conversation structure repair by Viterbi with survivor coalescence.

A conversation is well formed if its role initials read (s?(ua)+)?. Edits: Keep a row (0),
Rerole it to user or assistant (2), Delete it (3; blank and duplicate rows must go), Insert
an empty turn of user or assistant (2). A truncated row that stays adds 1. The cheapest
edits are taken, of equally cheap ones those whose initials (D, I, K, R) come first in ASCII.

Decoder. After every row at most four states survive: nothing said yet, after s, u, a; a state
that another one beats for certain, whatever follows, is dropped. The survivors' edits form a tree of back pointers with counts of references; a branch without survivors
is freed, and as soon as all survivors share an ancestor, the edits up to it are final and
leave the tree. Equally cheap ways into a state are compared over their whole unresolved
suffixes, back to where they part. Memory is that of the unresolved part.

What survives a row depends only on what was alive, by how much each was dearer than the
cheapest, and the order of their edits; these few cases are worked out once per process.

Distribution. An aggregate finds the conversations of more than one chunk, which has bounded
rows and bytes. All others are shuffled once, by conversation, and each is decoded once, in
one piece. Rows of the longer ones are range-partitioned by (conversation, turn, role, text),
so a long conversation spreads over many tasks, and cut into chunks. A chunk
is decoded from each state it may be entered in; what leaves it is a table of costs and the
order of its equally cheap ends. Chunk tables of one conversation are put together in groups
of FAN, and those again, as a tree, until one is left; down the tree every chunk then learns
where the best way enters and leaves it, and is decoded once more to give its edits.
There a row is a duplicate if an aggregate over
(conversation, role, text) knows an earlier turn, or if the row before it is equal.

Rows are ordered by turn, nulls first, then role and text; null roles and texts are read as
one space. Null conversation ids are one conversation. Repeated rows are rows. Columns other
than those named do not matter. An empty table gives an empty result.
"""
from __future__ import annotations

import functools
import hashlib
from collections import deque
from collections.abc import Iterator
from itertools import chain, groupby
from operator import itemgetter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from telemark.llm.tables import stored
from telemark.operators.joins import attach

CHUNK_ROWS, CHUNK_BYTES = 2048, 1 << 20
FAN = 64                 # chunk tables put together at a time
FAR = 1 << 60            # cost of what cannot be
START, S, U, A = range(4)
ROLE = {U: "user", A: "assistant"}
BLANKS = " \t\n\x0b\x0c\r"

# Ways of insertion before a row: per state (state reached, edits).
_NEXT = {START: U, S: U, U: A, A: U}
_AHEAD = {START: ((START, ""), (U, "I"), (A, "II")), S: ((S, ""), (U, "I"), (A, "II")), U: ((U, ""), (A, "I")), A: ((A, ""), (U, "I"))}


def _steps(initial: str, kind: int) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, edits) of all ways to deal with a row."""
    out = []
    for state, ahead in _AHEAD.items():
        for at, inserted in ahead:
            price = 2 * len(inserted)
            out.append((state, at, price + 3, inserted + "D"))
            if kind in (1, 2):
                continue
            price += kind == 3
            follow = _NEXT[at]
            if initial == "sua"[follow - 1] or (initial == "s" and at == START):
                out.append((state, S if initial == "s" else follow, price, inserted + "K"))
            out.append((state, follow, price + 2, inserted + "R"))
    return sorted(out, key=lambda x: (x[1], x[2], x[3]))


_STEPS = {(i, k): _steps(i, k) for i in ("s", "u", "a", "") for k in range(4)}


# _CATCH_UP[p][q]: at most so much more than a way from q costs some way from p, whatever follows.
_CATCH_UP = {START: {S: 0, U: 2, A: 4}, S: {START: 4, U: 2, A: 4}, U: {START: 5, S: 2, A: 2}, A: {START: 3, S: 0, U: 2}}


@functools.cache
def _survivors(alive: tuple[tuple[int, int], ...], initial: str, kind: int) -> tuple[int, tuple[tuple[int, int], ...], tuple[tuple[int, str], ...]]:
    """What survives a row. `alive` has (state, how much dearer than the cheapest) in the order
    of their edits. Returns what the cheapest has paid for the row, the new `alive`, and for
    each of it (place in the old one that it comes from, edits of the row)."""
    place = {state: (at, cost) for at, (state, cost) in enumerate(alive)}
    chosen: dict[int, tuple[int, int, str]] = {}
    for state, to, price, edits in _STEPS[initial, kind]:
        if state in place:
            at, cost = place[state]
            chosen[to] = min(chosen.get(to, (FAR, 0, "")), (cost + price, at, edits))
    # A state that another beats whatever follows does not survive.
    lost = {q for q in chosen for p in chosen if p != q and chosen[p][0] + _CATCH_UP[p][q] < chosen[q][0]}
    order = sorted(chosen.keys() - lost, key=lambda to: chosen[to][1:])
    low = min(chosen[to][0] for to in order)
    return low, tuple((to, chosen[to][0] - low) for to in order), tuple(chosen[to][1:] for to in order)


class _Node:
    __slots__ = ("edits", "parent", "level", "refs")

    def __init__(self, edits: str, parent: "_Node | None", level: int):
        self.edits, self.parent, self.level, self.refs = edits, parent, level, 0
        if parent is not None:
            parent.refs += 1


class Survivors:
    """Viterbi over the rows of one chunk, entered in one state. `final` gets the edits of
    every row as soon as all survivors agree on them, in order."""

    def __init__(self, entry: int, final=None):
        root = _Node("", None, -1)
        root.refs = 1
        self.paid = 0                           # by the cheapest survivor
        self.alive: tuple[tuple[int, int], ...] = ((entry, 0),)     # (state, dearer by), in the order of their edits
        self.nodes = [root]                     # of each of `alive`
        self.levels: deque[list] = deque()      # per unresolved row: [live nodes, ...]
        self.first, self.rows = 0, 0
        self.final = final or (lambda edits: None)

    def push(self, initial: str, kind: int) -> None:
        paid, self.alive, ways = _survivors(self.alive, initial if initial in ("s", "u", "a") else "", kind)
        self.paid += paid
        if len(ways) == 1 and not self.levels:  # nothing open before or after the row
            self.final(ways[0][1])
            self.first += 1
            self.rows += 1
            return
        old, self.nodes = self.nodes, [_Node(edits, self.nodes[at], self.rows) for at, edits in ways]
        self.levels.append(list(self.nodes))
        for node in self.nodes:
            node.refs += 1
        self.rows += 1
        for node in old:
            self._release(node)
        self._emit()

    def _release(self, node: _Node | None) -> None:
        while node is not None:
            node.refs -= 1
            if node.refs:
                return
            if node.level >= self.first:
                self.levels[node.level - self.first].remove(node)
            above, node.parent = node.parent, None
            node = above

    def _emit(self) -> None:
        """Edits of rows that only one live node is left for."""
        while self.levels and len(self.levels[0]) == 1:
            node = self.levels.popleft()[0]
            self.final(node.edits)
            self.first += 1
            node.parent = None      # the new root

    def finish(self, state: int) -> None:
        """Keep the survivor of one state only; gives out what is left."""
        for (other, _), node in zip(self.alive, self.nodes):
            if other != state:
                self._release(node)
        kept = [at for at, (other, _) in enumerate(self.alive) if other == state]
        self.alive, self.nodes = tuple(self.alive[at] for at in kept), [self.nodes[at] for at in kept]
        self._emit()

    def table(self) -> tuple[list[int], list[int]]:
        """(cost per state, states from the first in the order of their edits)."""
        dearer = dict(self.alive)
        return [self.paid + dearer[s] if s in dearer else FAR for s in range(4)], [*dearer, *(s for s in range(4) if s not in dearer)]


Table = tuple[list[list[int]], list[list[int]]]   # per entry: cost per exit, exits in the order of their edits


def chunk_table(initials: list[str], kinds: list[int]) -> Table:
    costs, orders = [], []
    for entry in range(4):
        run = Survivors(entry)
        for initial, kind in zip(initials, kinds):
            run.push(initial, kind)
        cost, order = run.table()
        costs.append(cost)
        orders.append(order)
    return costs, orders


def _step(cost: list[int], order: list[int], table: Table) -> tuple[list[int], list[int], list[int]]:
    """Survivors (cost and order per state) after one more chunk, and where each came from."""
    rank = {s: r for r, s in enumerate(order)}
    ways = []
    for to in range(4):
        ways.append(min((cost[s] + table[0][s][to], rank[s], s) for s in range(4)))
    came = [w[2] for w in ways]
    new = sorted(range(4), key=lambda to: (ways[to][1], table[1][came[to]].index(to)))
    return [min(w[0], FAR) for w in ways], new, came


def joined_table(tables: list[Table]) -> Table:
    """The table of chunks one after another."""
    costs, orders = [], []
    for entry in range(4):
        cost, order = [0 if s == entry else FAR for s in range(4)], [entry, *(s for s in range(4) if s != entry)]
        for t in tables:
            cost, order, _ = _step(cost, order, t)
        costs.append(cost)
        orders.append(order)
    return costs, orders


def states_between(tables: list[Table], entry: int, leave: int) -> list[int]:
    """The states in which the best way enters each chunk, when the last is left in `leave`."""
    cost, order = [0 if s == entry else FAR for s in range(4)], [entry, *(s for s in range(4) if s != entry)]
    back = []
    for t in tables:
        cost, order, came = _step(cost, order, t)
        back.append(came)
    states = [leave]
    for came in reversed(back):
        states.append(came[states[-1]])
    return states[::-1]


_TAIL = {START: "", S: "II", U: "I", A: ""}


def ending(costs: list[int], order: list[int]) -> tuple[int, int]:
    """(cost, state) at the end of a conversation, insertions at the end included."""
    cost, _, state = min((costs[s] + 2 * len(_TAIL[s]), order.index(s), s) for s in range(4))
    return cost, state


def last_state(table: Table) -> tuple[int, int]:
    """The end of a conversation whose chunks have this table together."""
    return ending(table[0][START], table[1][START])


class Repair:
    """Writes a chunk's edits and the repaired turns."""

    def __init__(self, entry: int, roles: list[str], texts: list[str]):
        self.state, self.roles, self.texts, self.at = entry, roles, texts, 0
        self.edits: list[str] = []
        self.out_roles: list[str] = []
        self.out_texts: list[str] = []

    def turn(self, role: str, text: str) -> None:
        self.out_roles.append(role)
        self.out_texts.append(text)

    def insert(self, edits: str) -> None:
        for _ in edits:
            self.state = _NEXT[self.state]
            self.turn(ROLE[self.state], "")

    def __call__(self, edits: str) -> None:
        if len(edits) > 1:
            self.insert(edits[:-1])
        role, text, last = self.roles[self.at], self.texts[self.at], edits[-1]
        if last == "R":
            self.state = _NEXT[self.state]
            role = ROLE[self.state]
        elif last == "K":
            self.state = S if role[:1] == "s" else _NEXT[self.state]
        if last != "D":
            self.turn(role, text)
        self.edits.append(edits)
        self.at += 1


def repaired_chunk(entry: int, leave: int, roles: list[str], texts: list[str], kinds: list[int], last: bool) -> Repair:
    found = Repair(entry, roles, texts)
    run = Survivors(entry, found)
    for role, kind in zip(roles, kinds):
        run.push(role[:1], kind)
    run.finish(leave)
    if last:
        found.insert(_TAIL[leave])
        found.edits.append(_TAIL[leave])
    return found


def repaired_whole(roles: list[str], texts: list[str], kinds: list[int]) -> tuple[int, Repair]:
    """Cost and repair of a conversation in one piece."""
    found = Repair(START, roles, texts)
    run = Survivors(START, found)
    for role, kind in zip(roles, kinds):
        run.push(role[:1], kind)
    cost, leave = ending(*run.table())
    run.finish(leave)
    found.insert(_TAIL[leave])
    found.edits.append(_TAIL[leave])
    return cost, found


def kinds_of(roles: list[str], texts: list[str]) -> list[int]:
    """The first fault of each row of a whole conversation: 1 blank, 2 duplicate, 3 truncated, else 0."""
    seen: set[tuple[str, str]] = set()
    kinds = []
    for said in zip(roles, texts):
        body = said[1].rstrip(BLANKS)
        kinds.append(1 if not body else 2 if said in seen else 3 if body[-1] not in ".!?" else 0)
        seen.add(said)
    return kinds


def counts(turns: list, roles: list[str], kinds: list[int]) -> tuple:
    """The values of _COUNTS for rows in order."""
    initials, numbered = [r[:1] for r in roles], [t for t in turns if t is not None]
    illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))
    first, last = (numbered[0], numbered[-1]) if numbered else (None, None)
    return kinds.count(1), kinds.count(2), kinds.count(3), illegal, initials[0], initials[-1], first, last, len(set(numbered))


# -- Spark ---------------------------------------------------------------------------------

def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Known faults put into conversations, by crc32(`conv:turn`) % 20: 0 drops the row, 1
    empties its text, 2 removes its [.!?], 3 repeats it, 4 makes it the user's. Nulls in the
    named columns are written as one space. Other columns are left out."""
    said = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_col, turn_col)])
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in (role_col, text_col))
    found = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"),
                        (F.crc32(said.cast("binary")) % 20).alias("case")).filter("case <> 0")
    once, twice = F.array(F.lit(0)), F.array(F.lit(0), F.lit(1))
    return found.select(
        F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.when(F.col("case") == 4, "user").otherwise(F.col("role")).alias(role_col),
        F.when(F.col("case") == 1, "").when(F.col("case") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias(text_col),
        F.explode(F.when(F.col("case") == 3, twice).otherwise(once)).alias("copy")).drop("copy")


def _key(conv: str = "conv"):
    """A conversation's id as a string that tells null apart."""
    return F.concat(F.when(F.col(conv).isNull(), "n").otherwise("c"), F.coalesce(F.col(conv).cast("string"), F.lit("")))


def _flagged(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, blank, later, cut) with `later`: the role and text were said in
    an earlier turn; `cut`: the last character that is no blank ends no sentence."""
    body = F.rtrim("text", F.lit(BLANKS))
    rows = rows.select("conv", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    marked = rows.withColumns({
        "c": _key(), "blank": body == "", "cut": ~F.substring(body, -1, 1).isin(".", "!", "?"),
        "said": F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))})
    first = stored(marked.filter("NOT blank").groupBy("c", "said").agg(
        F.min("turn").alias("first"), F.max(F.col("turn").isNull()).alias("before_all"), F.count("*").alias("n")).filter("n > 1").drop("n"), "said")
    later = F.col("turn").isNotNull() & (F.col("before_all") | (F.col("turn") > F.col("first")))
    return attach(marked, first, ["c", "said"], "left", salts=1).select(
        "conv", "turn", "role", "text", "blank", F.coalesce(later, F.lit(False)).alias("later"), "cut")


_COUNTED = ("blank long, duplicate long, truncated long, illegal long, first_initial string, last_initial string, "
            "first_turn {turn}, last_turn {turn}, turns long")
_COUNTS = tuple(c.split(" ")[0] for c in _COUNTED.split(", "))
_CHUNK = "conv {kind}, part long, roles array<string>, texts array<string>, kinds array<int>, costs array<long>, orders array<int>, " + _COUNTED
_REPAIRED = "conv {kind}, part long, only boolean, edits string, roles array<string>, texts array<string>, cost long, " + _COUNTED


def _kinds(rows: DataFrame) -> dict[str, str]:
    return {"kind": rows.schema["conv"].dataType.simpleString(), "turn": rows.schema["turn"].dataType.simpleString()}


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(_parse_datatype_string(ddl))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def whole(rows: DataFrame) -> DataFrame:
    """The repaired conversations of rows (conv, turn, role, text), each one chunk."""
    ddl = _REPAIRED.format(**_kinds(rows))
    schema = _arrow(ddl)
    placed = rows.select("conv", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")).repartition(
        "conv").sortWithinPartitions("conv", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        said = chain.from_iterable(zip(*(c.to_pylist() for c in b.columns)) for b in batches)
        out, held, size = [], 0, 0
        for conv, mine in groupby(said, itemgetter(0)):
            _, turns, roles, texts = map(list, zip(*mine))
            kinds = kinds_of(roles, texts)
            cost, done = repaired_whole(roles, texts, kinds)
            out.append((conv, 0, True, "".join(done.edits), done.out_roles, done.out_texts, cost, *counts(turns, roles, kinds)))
            held, size = held + len(roles), size + sum(map(len, texts))
            if held >= CHUNK_ROWS or size >= CHUNK_BYTES:
                yield _batch(out, schema)
                out, held, size = [], 0, 0
        if out:
            yield _batch(out, schema)

    return placed.mapInArrow(run, ddl)


def chunks(rows: DataFrame, most: int = CHUNK_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """Of rows (conv, turn, role, text) the conversations of one chunk, repaired, and the others,
    if there are any, as chunks of at most so many rows: `part` orders those of a conversation."""
    size = rows.groupBy("conv").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    longer = stored(size.filter((F.col("n") > most) | (F.col("bytes") > CHUNK_BYTES)).select(_key().alias("c")), "longer")
    if longer.isEmpty():
        return whole(rows), None
    keyed = rows.withColumn("c", _key())
    return (whole(attach(keyed, longer, "c", "left_anti", salts=1).drop("c")),
            cut_up(attach(keyed, longer, "c", "left_semi", salts=1).drop("c"), most))


def cut_up(rows: DataFrame, most: int) -> DataFrame:
    """Chunks of long conversations."""
    ddl = _CHUNK.format(**_kinds(rows))
    schema = _arrow(ddl)
    placed = _flagged(rows).repartitionByRange("conv", "turn", "role", "text").sortWithinPartitions("conv", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple | None = None
        number = TaskContext.get().partitionId() << 40
        turns, roles, texts, kinds, conv, size, out = [], [], [], [], None, 0, []

        def close() -> None:
            nonlocal number
            if not roles:
                return
            costs, orders = chunk_table([r[:1] for r in roles], kinds)
            out.append((conv, number, roles[:], texts[:], kinds[:], [c for x in costs for c in x], [o for x in orders for o in x],
                        *counts(turns, roles, kinds)))
            turns.clear(), roles.clear(), texts.clear(), kinds.clear()
            number += 1

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if roles and (row[0] != conv or len(roles) >= most or size >= CHUNK_BYTES):
                    close()
                    size = 0
                conv = row[0]
                again = row[5] or (before is not None and row[:4] == before)
                before = row[:4]
                turns.append(row[1])
                roles.append(row[2])
                texts.append(row[3])
                kinds.append(1 if row[4] else 2 if again else 3 if row[6] else 0)
                size += len(row[3])
                if len(out) >= 256 or sum(len(x[2]) for x in out) > CHUNK_ROWS:
                    yield _batch(out, schema)
                    out.clear()
        close()
        if out:
            yield _batch(out, schema)

    return placed.mapInArrow(run, ddl)


def _tables(costs: list[list[int]], orders: list[list[int]]) -> list[Table]:
    return [([c[i: i + 4] for i in (0, 4, 8, 12)], [o[i: i + 4] for i in (0, 4, 8, 12)]) for c, o in zip(costs, orders)]


def _ways(many: DataFrame) -> DataFrame:
    """(part, entry, leave, cost, last) for the chunks of conversations of several (c, part,
    place, costs, orders): tables put together up a tree, states handed down it."""
    levels = [many]
    while levels[-1].groupBy("c").count().filter("count > 1").limit(1).count():
        kind = levels[-1].schema

        def up(table: pa.Table) -> pa.Table:
            table = table.sort_by("place")
            costs, orders = joined_table(_tables(table["costs"].to_pylist(), table["orders"].to_pylist()))
            return pa.table({"c": table["c"].slice(0, 1), "part": table["part"].slice(0, 1), "place": pa.array([table["place"][0].as_py() // FAN], pa.int64()),
                             "costs": pa.array([[x for c in costs for x in c]], pa.list_(pa.int64())),
                             "orders": pa.array([[x for o in orders for x in o]], pa.list_(pa.int32()))})

        levels.append(stored(levels[-1].groupBy("c", F.floor(F.col("place") / FAN)).applyInArrow(up, kind), "level"))

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ends = [last_state(t) for t in _tables(b.column(3).to_pylist(), b.column(4).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array([START] * len(ends), pa.int32()), pa.array([s for _, s in ends], pa.int32()), pa.array([c for c, _ in ends], pa.int64())],
                ["c", "above", "entry", "leave", "cost"])

    known = levels[-1].mapInArrow(top, "c string, above long, entry int, leave int, cost long")
    for level in reversed(levels[:-1]):
        def down(table: pa.Table) -> pa.Table:
            table = table.sort_by("place")
            tables = _tables(table["costs"].to_pylist(), table["orders"].to_pylist())
            states = states_between(tables, table["entry"][0].as_py(), table["leave"][0].as_py())
            cost = [table["cost"][0].as_py()] + [0] * (len(tables) - 1)
            return pa.table({"c": table["c"], "part": table["part"], "above": table["place"], "entry": pa.array(states[:-1], pa.int32()),
                             "leave": pa.array(states[1:], pa.int32()), "cost": pa.array(cost, pa.int64())})

        below = level.withColumn("above", F.floor(F.col("place") / FAN)).join(
            known.select("c", "above", "entry", "leave", "cost"), ["c", "above"]).select(
            "c", "part", "place", "costs", "orders", "entry", "leave", "cost", "above")
        known = stored(below.groupBy("c", "above").applyInArrow(down, "c string, part long, above long, entry int, leave int, cost long"), "known")
    return known.select("part", "entry", "leave", "cost")


def _ways_through(cut: DataFrame) -> DataFrame | None:
    """(part, entry, leave, cost, ends) for the chunks of conversations that have several."""
    listed = cut.select(_key().alias("c"), "part", "costs", "orders")
    several = stored(listed.groupBy("c").agg(F.count("*").alias("n"), F.max("part").alias("end")).filter("n > 1"), "several")
    if several.isEmpty():
        return None
    # Within a task a conversation's chunks have numbers in a row; the tasks before count on.
    parts = attach(listed, several.select("c"), "c", "inner", salts=1).withColumn("task", F.shiftright("part", 40))
    slices = parts.groupBy("c", "task").agg(F.min("part").alias("low"), F.count("*").alias("size"))
    before = F.sum("size").over(Window.partitionBy("c").orderBy("task")) - F.col("size")
    placed = parts.join(slices.withColumn("ahead", before), ["c", "task"])
    many = stored(placed.select("c", "part", (F.col("part") - F.col("low") + F.col("ahead")).alias("place"), "costs", "orders"), "many")
    ends = several.select(F.col("end").alias("part"), F.lit(True).alias("ends"))
    return stored(_ways(many).join(ends, "part", "left"), "ways")


def _repaired(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> tuple[DataFrame, DataFrame | None]:
    """repair() in two frames: conversations of one chunk, and those of several, if any."""
    slim = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    single, cut = chunks(slim)
    if cut is None:
        return single, None
    cut = stored(cut, "chunks")
    ways = _ways_through(cut)
    if ways is None:
        full = cut.withColumns({c: F.lit(None).cast(t) for c, t in (("entry", "int"), ("leave", "int"), ("cost", "long"), ("ends", "boolean"))})
    else:
        full = attach(cut, ways, "part", "left", salts=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = {c: b.column(b.schema.get_field_index(c)) for c in b.schema.names}
            of = {c: got[c].to_pylist() for c in ("roles", "texts", "kinds", "costs", "orders", "entry", "leave", "cost", "ends")}
            done, only, cost = [], [], []
            for r in range(b.num_rows):
                entry, leave, paid, ends = (of[c][r] for c in ("entry", "leave", "cost", "ends"))
                only.append(entry is None)
                if entry is None:
                    paid, leave = last_state(_tables([of["costs"][r]], [of["orders"][r]])[0])
                    entry, ends = START, True
                cost.append(paid)
                done.append(repaired_chunk(entry, leave, of["roles"][r], of["texts"][r], of["kinds"][r], bool(ends)))
            words = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [got["conv"], got["part"], pa.array(only), pa.array(["".join(x.edits) for x in done]), pa.array([x.out_roles for x in done], words),
                 pa.array([x.out_texts for x in done], words), pa.array(cost, pa.int64()), *(got[c] for c in _COUNTS)],
                ["conv", "part", "only", "edits", "roles", "texts", "cost", *_COUNTS])

    return single, full.mapInArrow(run, _REPAIRED.format(**_kinds(slim)))


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The repaired conversations in chunks (conv, part, only, edits, roles, texts, cost, ...):
    in the order of `part` a conversation's chunks give its edits and its turns. `only`: the
    conversation has no other chunk. Cost and counts of faults are the chunk's share; `turns`
    counts distinct turns between `first_turn` and `last_turn`."""
    single, longer = _repaired(rows, conv_col, turn_col, role_col, text_col)
    return single if longer is None else single.unionByName(longer)


def digest(single: DataFrame, longer: DataFrame | None = None) -> DataFrame:
    """One row per conversation of repair()'s frames: gaps, counts, cost, audit and the hash of
    the repaired turns. One of several chunks (all in `longer`) is read chunk by chunk in order,
    as its hash demands."""
    names = ("conv", "first_turn", "last_turn", "turns", *_COUNTS[:4], "cost", "audit", "repaired_sha256")
    body = F.concat_ws("\n", F.zip_with("roles", "texts", lambda role, text: F.concat(role, F.lit(":"), text)))
    found = single.withColumns({"audit": F.col("edits"), "repaired_sha256": F.sha2(body.cast("binary"), 256)}).select(*names)
    if longer is not None:
        found = found.unionByName(_joined_digests(longer.withColumn("body", body), names))
    return found.withColumn("gaps", (F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns")).cast("long")).drop("first_turn", "last_turn", "turns")


def _joined_digests(lines: DataFrame, names: tuple[str, ...]) -> DataFrame:
    kinds = {c: lines.schema[c].dataType.simpleString() for c in ("conv", "cost", *_COUNTS)}
    schema = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in names)
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, sha, before, edits = None, None, None, []
        for b in batches:
            out = []
            for x in b.to_pylist():
                body = x["body"].encode()
                if open_ is not None and x["conv"] == open_["conv"]:
                    for c in ("blank", "duplicate", "truncated", "cost"):
                        open_[c] += x[c]
                    open_["illegal"] += x["illegal"] + (before + x["first_initial"] not in ("su", "ua", "au"))
                    if x["turns"]:
                        open_["turns"] += x["turns"] - (x["first_turn"] == open_["last_turn"])
                        open_["last_turn"] = x["last_turn"]
                        if open_["first_turn"] is None:
                            open_["first_turn"] = x["first_turn"]
                else:
                    if open_ is not None:
                        out.append(open_ | {"audit": "".join(edits), "repaired_sha256": sha.hexdigest()})
                    open_, sha, edits, said = {c: x.get(c) for c in names}, hashlib.sha256(), [], False
                edits.append(x["edits"])
                if body:
                    sha.update((b"\n" if said else b"") + body)
                    said = True
                before = x["last_initial"]
            if out:
                yield pa.RecordBatch.from_pylist(out, arrow)
        if open_ is not None:
            yield pa.RecordBatch.from_pylist([open_ | {"audit": "".join(edits), "repaired_sha256": sha.hexdigest()}], arrow)

    slim = lines.select("conv", "part", "edits", "cost", *_COUNTS, "body")
    return slim.repartition("conv").sortWithinPartitions("conv", "part").mapInArrow(run, schema)


def report(rows: DataFrame, damaged: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """One row per conversation of `rows`: gaps in the turns of `damaged`, its faults, and what
    repair() does to it. A conversation without damaged rows has zeros and nothing to hash."""
    found = digest(*_repaired(damaged, conv_col, turn_col, role_col, text_col)).withColumnRenamed("conv", "of")
    every = rows.select(F.col(conv_col).alias("conv")).distinct()
    both = every.join(found, F.col("conv").eqNullSafe(F.col("of")), "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return both.select(F.col("conv").alias(conv_col), *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
