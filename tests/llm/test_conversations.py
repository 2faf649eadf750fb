import hashlib
import itertools
import random
import re
import zlib

import duckdb
from pyspark.sql import functions as F

from ledgerly.llm import conversations as C
from ledgerly.llm.queries import op11_conversation_repair
from tests.llm.conftest import SF

SCHEMA = "conv_id long, turn long, role string, text string"
SOLID = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(rows):
    """All edit scripts: every row's edit, up to two rows inserted in each gap."""
    adds = ["", "u", "a", "uu", "ua", "au", "aa"]
    best = None
    for gaps in itertools.product(adds, repeat=len(rows) + 1):
        for edits in itertools.product("DKua", repeat=len(rows)):
            cost, audit, roles = 2 * sum(map(len, gaps)), "", ""
            for gap, edit, (role, must_go, cut) in zip(gaps, edits, rows):
                if must_go and edit != "D":
                    break
                audit += "I" * len(gap) + (edit if edit in "DK" else "R")
                roles += gap + ("" if edit == "D" else role if edit == "K" else edit)
                cost += 3 if edit == "D" else cut + 2 * (edit != "K")
            else:
                audit, roles = audit + "I" * len(gaps[-1]), roles + gaps[-1]
                if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
    return best


def by_strings(rows):
    """The same by a table of (cost, audit) pairs compared as they are."""
    def step(state, role):
        return {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}[state].get(role)

    def add(table):
        for _ in range(4):
            for s in ("", "s", "u", "a"):
                for r in "ua":
                    if (t := step(s, r)) in table:
                        c, a, text = table[t]
                        table[s] = min(table.get(s, (1 << 60,)), (c + 2, "I" + a, [(r, None), *text]))
        return table

    after = add({"": (0, "", []), "a": (0, "", [])})
    for i in range(len(rows) - 1, -1, -1):
        role, must_go, cut = rows[i]
        now = {}
        for s in ("", "s", "u", "a"):
            options = [(s, 3, "D", [])]
            if not must_go:
                options += [(step(s, role), cut, "K", [(role, i)])]
                options += [(step(s, r), cut + 2, "R", [(r, i)]) for r in "ua"]
            for t, cost, letter, kept in options:
                if t in after:
                    c, a, text = after[t]
                    now[s] = min(now.get(s, (1 << 60,)), (c + cost, letter + a, kept + text))
        after = add(now)
    return after[""]


def expected(table):
    """Rows of (conv_id, turn, role, text) -> {conv_id: result}."""
    out = {}
    for conv in {r[0] for r in table}:
        rows = []
        for _, turn, role, text in (r for r in table if r[0] == conv):
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            kind = zlib.crc32(key.encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            if kind == 1:
                text = ""
            elif kind == 2:
                text = re.sub("[.!?]", "", text)
            elif kind == 4:
                role = "user"
            rows += [(turn is not None, turn or 0, role, text, turn)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        rows.sort(key=lambda r: r[:4])
        seen, faults = set(), []
        for _, _, role, text, _ in rows:
            solid = SOLID.findall(text)
            faults.append("b" if not solid else "d" if (role, text) in seen
                          else "t" if solid[-1] not in ".!?" else "-")
            seen.add((role, text))
        initials = [r[2][:1] for r in rows]
        turns = {r[4] for r in rows if r[4] is not None}
        cost, audit, script = by_strings([(i, f in "bd", f == "t") for i, f in zip(initials, faults)])
        lines = []
        for role, i in script:
            name = {"s": "system", "u": "user", "a": "assistant"}[role]
            if i is not None and initials[i] == role:
                name = rows[i][2]
            lines.append(f"{name}:{'' if i is None else rows[i][3]}")
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                     faults.count("b"), faults.count("d"), faults.count("t"),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                     cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def results(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[n] for n in names) for r in rows}


def test_all_scripts():
    for seed in range(40):
        rnd = random.Random(seed)
        rows = [(rnd.choice("suax"), rnd.random() < 0.2, rnd.random() < 0.3) for _ in range(rnd.randint(0, 3))]
        cost, audit, _, _ = C.repair(rows)
        assert (cost, audit) == cheapest(rows), rows


def test_blocks_agree():
    for seed in range(300):
        rnd = random.Random(seed)
        rows = [(rnd.choice("ssuuaax"), rnd.random() < 0.2, rnd.random() < 0.3)
                for _ in range(rnd.randint(0, 30))]
        whole = C.repair(rows, 1000)
        assert whole[:2] == by_strings(rows)[:2]
        for block in (1, 2, 7):
            assert C.repair(rows, block) == whole


def test_long_conversation():
    rnd = random.Random(5)
    rows = [(rnd.choice("uuaax"), rnd.random() < 0.1, rnd.random() < 0.3) for _ in range(20000)]
    cost, audit, plan, tail = C.repair(rows)
    assert len(plan) == len(rows) and audit.count("D") == sum(p.endswith("-") for p in plan)
    roles = "".join("".join(c for c in p[:-1]) + ({"-": "", "=": r[0]}.get(p[-1], p[-1].lower()))
                    for p, r in zip(plan, rows)) + tail
    assert re.fullmatch("(ua)*", roles)
    assert cost == 2 * (audit.count("I") + audit.count("R")) + 3 * audit.count("D") + sum(
        r[2] for p, r in zip(plan, rows) if p[-1] != "-")


def test_query(spark):
    table = duckdb.sql(f"select conv_id, turn, role, text from '{SF}/conversations.parquet'").fetchall()
    assert results(op11_conversation_repair(spark, SF)) == expected(table)


def hard_cases():
    rnd = random.Random(1)
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rnd.randint(1, 9)):
            rows.append((conv, None if rnd.random() < 0.1 else turn,
                         rnd.choice(["user", "assistant", "system", "tool", "", None]),
                         rnd.choice(["Fine. ", "No end", " \n\t", None, "", "Ünï?", "same.", "x ", "A.\n"])))
    rows += rows[:20]                                        # repeated rows
    rows.append((900, 0, "user", "w " * 200_000 + "."))      # a very long text
    rows += [(901, None, "user", "All null turns."), (901, None, "assistant", "Yes.")]
    rows += [(902, -2**63, "user", "Far."), (902, 2**63 - 1, "assistant", "Apart.")]
    rows += [(2**62 + 1, i, "user", "Large id.") for i in range(3)]
    return rows


def test_edge_cases(spark):
    rows = hard_cases()
    df = spark.createDataFrame(rows, SCHEMA)
    got = results(C.repair_conversations(C.damaged(df)))
    want = expected(rows)
    far = 2**64 - 2   # beyond a long
    assert {k: (None, *v[1:]) if v[0] == far else v for k, v in want.items()} == got


def test_extra_columns_and_empty_table(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Hello.")]
    df = spark.createDataFrame(rows, SCHEMA)
    crowded = df.select("*", *[F.lit("x").alias(c) for c in ("pos", "fault", "audit", "copies", "plan", "gaps")])
    assert results(C.repair_conversations(C.damaged(crowded))) == expected(rows)
    empty = C.repair_conversations(C.damaged(df.limit(0)))
    assert empty.count() == 0 and "repaired_sha256" in empty.columns


def test_conversation_of_a_third_of_all_rows(spark):
    rows = [(7, i, "user" if i % 2 == 0 else "assistant", f"Row {i}.") for i in range(3000)]
    rows += [(100 + i, i % 4, "user", f"Row {i % 5}") for i in range(6000)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert results(C.repair_conversations(C.damaged(df))) == expected(rows)
