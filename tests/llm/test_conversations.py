"""Conversation repair against a plain re-computation that keeps every way in full."""
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from telemark.llm import conversations as C
from telemark.llm import queries as Q
from telemark.llm.tables import stored

FULL = re.compile(r"(s?(ua)+)?\Z")
R = random.Random(5)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        case = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if case == 4:
            role = "user"
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        out += [(conv, turn, role, text)] * (0 if case == 0 else 2 if case == 3 else 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))


def kinds(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        out.append(1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """(cost, audit, turns): all ways per reached end of the roles said, the best kept."""
    def said(roles):
        return roles[-1:] if roles[-1:] != "s" or len(roles) == 1 else "?"

    def legal(roles):
        return re.fullmatch(r"s?(ua)*u?", roles) is not None

    def inserted(ways):
        best, todo = {}, list(ways.values())
        while todo:
            way = todo.pop()
            cost, audit, roles, turns = way
            old = best.get(said(roles))
            if old is not None and old[:2] <= way[:2]:
                continue
            best[said(roles)] = way
            todo += [(cost + 2, audit + "I", roles + r[0], (*turns, r + ":")) for r in ("user", "assistant") if legal(roles + r[0])]
        return best

    ways = {"": (0, "", "", ())}
    for (_, _, role, text), fault in zip(rows, faults):
        found = {}
        for cost, audit, roles, turns in inserted(ways).values():
            options = [(cost + 3, audit + "D", roles, turns)]
            if fault not in (1, 2):
                extra = cost + (fault == 3)
                options += [(extra + (r != role) * 2, audit + ("K" if r == role else "R"), roles + r[:1], (*turns, r + ":" + text))
                            for r in {role, "user", "assistant"} if r and legal(roles + r[0])]
            for way in options:
                key = said(way[2])
                if key not in found or way[:2] < found[key][:2]:
                    found[key] = way
        ways = found
    done = [w for w in inserted(ways).values() if FULL.match(w[2])]
    return min(done, key=lambda w: w[:2])


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        mine = damaged([r for r in rows if r[0] == conv])
        faults = kinds(mine)
        cost, audit, _, turns = cheapest(mine, faults) if mine else (0, "", "", ())
        turn = [r[1] for r in mine if r[1] is not None]
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        out[conv] = (max(turn) - min(turn) + 1 - len(set(turn)) if turn else 0, *(faults.count(k) for k in (1, 2, 3)), illegal,
                     cost, audit, hashlib.sha256("\n".join(turns).encode()).hexdigest())
    return out


def got(frame):
    rows = frame.collect()
    assert frame.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


def conversation(conv, n, messy):
    roles = ["system", *["user", "assistant"] * n][:n] if messy < 0.5 else [R.choice(["system", "user", "assistant", "tool", "", None, "support"]) for _ in range(n)]
    return [(conv, None if R.random() < messy / 9 else i - R.randrange(2), r,
             R.choice(["fine.", "good!", "cut", " ", "", None, "same.", "é.", f"text {i}. \n"])) for i, r in enumerate(roles)]


@pytest.fixture(scope="module")
def rows():
    out = [r for c in range(60) for r in conversation(c, R.randrange(1, 14), R.choice([0.1, 0.9, 1.0]))]
    out += conversation(100, 400, 0.9) + conversation(101, 300, 0.2) + conversation(None, 9, 0.9)
    out += [(102, 1, "user", "again.")] * 40 + [(103, None, None, None)] * 3
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {c: F.lit("x") for c in ("conv", "c", "said", "part", "cost", "audit", "kinds")}).repartition(3)


def test_whole_conversations(spark, rows):
    said = frame(spark, rows)
    assert got(C.report(said, C.damage(said))) == expected(rows)


@pytest.mark.parametrize("size, fan", [(1, 2), (3, 2), (7, 64)])
def test_conversations_in_chunks(spark, rows, size, fan, monkeypatch):
    monkeypatch.setattr(C, "FAN", fan)
    some = [r for r in rows if r[0] in (100, 101, 102, None, 1, 2)]
    said = frame(spark, some)
    monkeypatch.setattr(C.chunks, "__defaults__", (size,))
    assert got(C.report(said, C.damage(said))) == expected(some)


def test_nothing(spark, rows):
    said = frame(spark, rows).filter("false")
    assert C.report(said, C.damage(said)).count() == 0


def test_tree_is_freed_and_ties_take_the_first_in_ascii():
    given = []
    run = C.Survivors(C.START, given.append)
    most = 0
    for i in range(5000):
        run.push("ua"[i % 2], 0)
        most = max(most, len(run.levels))
    assert most < 20 and len(given) > 4900       # settled as it goes
    given.clear()
    run = C.Survivors(C.START, given.append)
    for _ in range(300):
        run.push("u", 1)                         # only deletions: nothing to choose
    run.finish(C.START)
    assert given == ["D"] * 300
    # u u: a reply put in between (2), or one of them deleted (3) or made a reply (2).
    faults = [0, 0]
    table = C.chunk_table(["u", "u"], faults)
    cost, state = C.last_state(table)
    done = C.repaired_chunk(C.START, state, ["user"] * 2, ["x.", "y."], faults, True)
    assert (cost, done.edits, done.out_roles) == (2, ["K", "R", ""], ["user", "assistant"])


def test_what_is_dropped_never_wins():
    for _ in range(200):
        n = R.randrange(1, 9)
        roles = [R.choice(["system", "user", "assistant", "tool"]) for _ in range(n)]
        faults = [R.choice([0, 0, 0, 1, 2, 3]) for _ in range(n)]
        want = cheapest([(0, i, r, "x") for i, r in enumerate(roles)], faults)
        cost, state = C.last_state(C.chunk_table([r[0] for r in roles], faults))
        done = C.repaired_chunk(C.START, state, roles, ["x"] * n, faults, True)
        assert (cost, "".join(done.edits)) == want[:2]
        assert tuple(f"{r}:{t}" for r, t in zip(done.out_roles, done.out_texts)) == want[3]


def test_chunk_tables_join_as_the_whole():
    for _ in range(60):
        n = R.randrange(2, 40)
        initials, faults = [R.choice("suat") for _ in range(n)], [R.choice([0, 0, 0, 1, 2, 3]) for _ in range(n)]
        cuts = sorted({0, n, *(R.randrange(n) for _ in range(4))})
        parts = [C.chunk_table(initials[a:b], faults[a:b]) for a, b in zip(cuts, cuts[1:])]
        whole = C.chunk_table(initials, faults)
        joined = C.joined_table(parts)
        assert C.last_state(joined) == C.last_state(whole)
        states = C.states_between(parts, C.START, C.last_state(joined)[1])
        edits = []
        for (a, b), entry, leave in zip(zip(cuts, cuts[1:]), states, states[1:]):
            edits += C.repaired_chunk(entry, leave, initials[a:b], [""] * n, faults[a:b], b == n).edits
        done = C.repaired_chunk(C.START, C.last_state(whole)[1], initials, [""] * n, faults, True)
        assert "".join(edits) == "".join(done.edits)


def test_query_on_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(Q.queries()["op12_conversation_repair"](spark, "/root/testdata/sf0.01")) == expected(rows)


def test_short_conversations_are_shuffled_and_decoded_once(spark, rows, monkeypatch):
    labels, decoded = [], []
    monkeypatch.setattr(C, "stored", lambda df, label: labels.append(label) or stored(df, label))
    said = frame(spark, rows)
    done = C.report(said, C.damage(said))
    assert got(done) == expected(rows)
    assert labels == ["longer"]                  # which has no row: nothing else is written
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("RepartitionByExpression") == 1 and plan.count("Join") == 1
    monkeypatch.setattr(C.Survivors, "push", lambda self, *row, push=C.Survivors.push: decoded.append(row) or push(self, *row))
    C.repaired_whole(["user", "assistant"], ["x.", "y."], [0, 0])
    assert len(decoded) == 2


def test_few_long_rows_are_cut_too(spark, rows, monkeypatch):
    labels = []
    monkeypatch.setattr(C, "stored", lambda df, label: labels.append(label) or stored(df, label))
    monkeypatch.setattr(C, "CHUNK_BYTES", 12)
    some = [r for r in rows if r[0] in (100, 102, None, *range(20))]
    said = frame(spark, some)
    assert got(C.report(said, C.damage(said))) == expected(some)
    assert {"longer", "chunks", "ways"} <= set(labels)
