"""Repairs against all edit sequences of short conversations and a plain table of paths."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from titlelens.llm.conversations import damaged, edits, repair, repair_report, solve
from titlelens.llm.queries import QUERIES

SHAPE = re.compile(r"(s?(ua)+)?")
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def by_all_sequences(kinds):
    """Every sequence of letters with at most three insertions."""
    found = []

    def grow(at, roles, audit, cost, inserts):
        if at == len(kinds) and SHAPE.fullmatch(roles):
            found.append((cost, audit))
        if inserts < 3:
            for role in "ua":
                grow(at, roles + role, audit + "I", cost + 5, inserts + 1)
        if at < len(kinds):
            kind = kinds[at]
            grow(at + 1, roles, audit + "D", cost + 2, inserts)
            if kind != "x":
                more = 5 if kind.isupper() else 0
                for role in "ua":
                    grow(at + 1, roles + role, audit + "R", cost + 1 + more, inserts)
                grow(at + 1, roles + kind.lower(), audit + "K", cost + more, inserts)

    grow(0, "", "", 0, 0)
    return min(found)


def by_table(kinds):
    """The least (cost, audit) of each state after each row."""
    def inserted(states):
        for _ in range(3):
            for state, (cost, audit) in list(states.items()):
                to, way = NEXT[state], (cost + 5, audit + "I")
                states[to] = min(states.get(to, way), way)
        return states

    states = inserted({"": (0, "")})
    for kind in kinds:
        after = {}
        for state, (cost, audit) in states.items():
            ways = [(state, 2, "D")]
            if kind != "x":
                more = 5 if kind.isupper() else 0
                ways.append((NEXT[state], 1 + more, "R"))
                role = kind.lower()
                if role == NEXT[state] or (role == "s" and state == ""):
                    ways.append((role, more, "K"))
            for to, more, letter in ways:
                way = (cost + more, audit + letter)
                after[to] = min(after.get(to, way), way)
        states = inserted(after)
    return min(states[s] for s in ("", "a") if s in states)


@pytest.mark.parametrize("n", range(5))
def test_all_short_sequences(n):
    for kinds in product("suaoUAx", repeat=n) if n < 4 else product("uaUx", repeat=4):
        assert solve("".join(kinds)) == by_all_sequences(kinds), kinds


def test_long_sequences():
    rng = random.Random(3)
    for n in (6, 9, 30, 70, 400):
        for _ in range(60 if n < 400 else 5):
            kinds = "".join(rng.choice("ssuuuaaaoSUAOxx") for _ in range(n))
            assert edits(kinds) == by_table(kinds), kinds
    assert solve("ua" * 30_000) == (0, "K" * 60_000)
    assert solve("u" * 5001)[0] == 2500 + 2


def plain_damage(rows):
    out, ids = [], set()
    for conv_id, turn, role, text in rows:
        show = [" " if v is None else str(v) for v in (conv_id, turn, role, text)]
        ids.add(conv_id)
        which = zlib.crc32(f"{show[0]}:{show[1]}".encode()) % 20
        role, text = show[2:]
        if which == 1:
            text = ""
        if which == 2:
            text = re.sub("[.!?]", "", text)
        if which == 4:
            role = "user"
        out += [(conv_id, turn, role, text)] * ((which != 0) + (which == 3))
    return ids, out


def plain_report(ids, rows):
    report = {}
    for conv_id in ids:
        mine = sorted((r for r in rows if r[0] == conv_id),
                      key=lambda r: (r[1] is not None, r[1] or 0))
        turns = [r[1] for r in mine if r[1] is not None]
        kinds, seen, counts = "", set(), {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in mine:
            kind = role[:1] if role[:1] in ("s", "u", "a") else "o"
            held = re.findall(r"[^\x20\x09-\x0D]", text)
            if not held:
                counts["blank"] += 1
                kind = "x"
            elif (role, text) in seen:
                counts["duplicate"] += 1
                kind = "x"
            elif held[-1] not in ".!?":
                counts["truncated"] += 1
                kind = kind.upper()
            seen.add((role, text))
            kinds += kind
        initials = [r[2][:1] for r in mine]
        cost, audit = by_table(kinds)
        rest, roles, lines = iter(mine), "", []
        for letter in audit:
            row = next(rest) if letter != "I" else ("", "", "", "")
            if letter in "KRI":
                due = {"u": "user", "a": "assistant"}[NEXT[roles[-1:]]]
                role = row[2] if letter == "K" else due
                roles += role[0]
                lines.append(f"{role}:{row[3]}")
        report[conv_id] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts.values(),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return report


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
           "repaired_sha256"]


def _report(df):
    rows = [tuple(r[c] for c in COLUMNS) for r in df.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def test_query_equals_plain_python(spark):
    data = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert _report(QUERIES["op11_conversation_repair"](spark, data)) == plain_report(
        *plain_damage(rows))


ODD = [(1, 0, "system", "Be brief."), (1, 1, "user", "Hi!"), (1, 3, "assistant", "Yes, and"),
       (1, 7, "user", "Hi!"), (2, None, "user", "What?"), (2, 2, "assistant", "  That. \t\x0b"),
       (2, 2, "assistant", "  That. \t\x0b"), (3, None, None, None), (None, 5, "user", "Null id."),
       (None, 6, "agent", "Kept as it is."), (4, 1, "", "No role."), (5, 1, "tool", "Other!"),
       (6, 0, "user", "ends with a long run." + " \n" * 5000), (6, 1, "user", "é" * 50_000)]
SCHEMA = "conv_id long, turn long, role string, text string"


def test_odd_rows(spark):
    df = spark.createDataFrame(ODD, SCHEMA)
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in ODD]
    assert _report(repair_report(df)) == plain_report({r[0] for r in ODD}, plain)
    assert _report(repair_report(damaged(df), "present")) == plain_report(*plain_damage(ODD))


def test_conversation_without_rows(spark):
    gone = next(i for i in range(999) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)
    assert _report(repair_report(damaged(df), "present")) == {
        gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert repair_report(df.limit(0)).collect() == [] == repair(df.limit(0)).collect()


def test_order_extra_columns_and_many_partitions(spark):
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), rng.choice(["A.", "B", "C?", ""]))
            for c in range(30) for t in range(rng.randrange(12))]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "false present", "'x' audit", "1 kind", "2 h1", "3 found").repartition(7)
    assert _report(repair_report(df)) == plain_report({r[0] for r in rows}, rows)


def test_repaired_rows(spark):
    got = repair(spark.createDataFrame(ODD, SCHEMA)).collect()
    assert all(SHAPE.fullmatch("".join(r["role"][0] for r in sorted(
        (r for r in got if r["conv_id"] == c), key=lambda r: r["position"]))) for c in
        {r[0] for r in ODD})
    first = [(r["position"], r["role"], r["text"], r["edit"]) for r in got if r["conv_id"] == 1]
    # Two new roles and two rows less cost 6; to keep the unfinished turn would cost 7.
    assert sorted(first) == [(0, "user", "Be brief.", "R"), (1, "assistant", "Hi!", "R")]
