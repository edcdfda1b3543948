"""Conversation repair against an exhaustive search over all edit strings."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

from helpers import SF01

from quartermaster.llm import conversation_repair as cr

SPACE = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        draw = zlib.crc32(key.encode()) % 20
        if draw == 1:
            text = ""
        if draw == 2:
            text = re.sub("[.!?]", "", text)
        if draw == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(draw, 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.rstrip(SPACE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else
                   "" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def plain_repair(rows, found):
    """(cost, audit, repaired) by trying ever more edits, cheapest and least
    audit first: a search over (row, role initials so far) without the DP."""
    best = None
    todo = [(0, "", 0, "")]  # cost, audit, row, state in "", s, u, a
    # Forward search that keeps every undominated (cost, audit) per (row, state).
    layers = {}
    while todo:
        cost, audit, k, state = todo.pop()
        if best and (cost > best[0]):
            continue
        key = (k, state, len(audit))
        if key in layers and layers[key] <= (cost, audit):
            continue
        layers[key] = (cost, audit)
        if k == len(rows) and state in ("", "a"):
            if best is None or (cost, audit) < best:
                best = (cost, audit)
        turn = "a" if state == "u" else "u"
        if not audit.endswith("III"):
            todo.append((cost + 3, audit + "I", k, turn))
        if k < len(rows):
            todo.append((cost + 4, audit + "D", k + 1, state))
            if found[k] not in ("blank", "duplicate"):
                extra = 3 if found[k] == "truncated" else 0
                todo.append((cost + 3 + extra, audit + "R", k + 1, turn))
                first = rows[k][1][:1]
                if first == turn or (first == "s" and state == ""):
                    todo.append((cost + extra, audit + "K", k + 1, first))
    cost, audit = best
    out, k, state = [], 0, ""
    for e in audit:
        turn = "a" if state == "u" else "u"
        name = "user" if turn == "u" else "assistant"
        if e == "I":
            out.append(f"{name}:")
            state = turn
        else:
            if e == "R":
                out.append(f"{name}:{rows[k][2]}")
                state = turn
            if e == "K":
                out.append(f"{rows[k][1]}:{rows[k][2]}")
                state = rows[k][1][0]
            k += 1
    assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in out))
    return cost, audit, "\n".join(out)


def plain(rows, ids):
    """The contract's rows for damaged ``rows(conv, turn, role, text)``."""
    by_conv = {}
    for conv, *r in rows:
        by_conv.setdefault(conv, []).append(tuple(r))
    out = []
    for conv in ids:
        mine = sorted(by_conv.get(conv, []), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        found = faults(mine)
        turns = [r[0] for r in mine if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(mine)]
        cost, audit, text = plain_repair(mine, found)
        out.append((conv, gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"),
                    sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


COLS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def result(df):
    assert df.columns == COLS
    return sorted(map(tuple, df.collect()), key=repr)


def test_whole_table_equals_search(spark):
    table = spark.read.parquet(f"{SF01}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = [tuple(r) for r in table.collect()]
    want = plain(plain_damage(rows), {r[0] for r in rows})
    assert {"I", "D", "K", "R"} <= set("".join(r[7] for r in want))
    from pyspark.sql import functions as F
    assert result(cr.report(cr.damage(table), gone=F.col("gone"))) == want


def test_random_conversations_equal_search(spark):
    rng = random.Random(4)
    rows = []
    for conv in range(150):
        for _ in range(rng.randint(0, 9)):
            rows.append((conv, rng.choice([None, *range(6)]), rng.choice(["user", "assistant", "system", "tool", "", None]),
                         rng.choice(["Yes.", "No!", "cut", "", " \t", None, "end? \n", "É"])))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    filled = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert result(cr.report(df)) == plain(filled, {r[0] for r in rows})


def test_cheapest_equals_search_on_all_short_conversations():
    kinds = [4 * f + k for f in range(3) for k in range(4) if (f, k) != (1, 0)]
    for n in range(4):
        for rows in itertools.product(kinds, repeat=n):
            plain_rows = [(0, "sua "[r & 3], "x") for r in rows]
            found = [("", "blank", "truncated")[r >> 2] for r in rows]
            assert cr.cheapest(bytes(rows)) == plain_repair(plain_rows, found)[:2], rows


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "user", "cut"), (1, 2, "user", "Q?"), (1, 3, "user", "Q?"), (2, 0, "system", "S.")]
    got = sorted(map(tuple, cr.repair(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert [r[3] for r in got if r[0] == 1] == ["user", "assistant"] * (len(got) // 2)
    assert all(r[0] == 1 for r in got)  # a lone system row is deleted


def test_edge_cases(spark):
    from pyspark.sql import functions as F
    rows = [(None, 0, "user", "A."), (None, 1, "assistant", "B."), (7, None, None, None), (8, None, "user", "x" * 300_000 + "."),
            (9, 5, "user", "A."), (9, 5, "assistant", "A."), (9, 5, "user", "A."), (10, 2, "", "A.")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as gaps", "'x' as audit", "2 as draw", "3 as gone")
    filled = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert result(cr.report(df)) == plain(filled, {r[0] for r in rows})
    assert result(cr.report(cr.damage(df), gone=F.col("gone"))) == plain(plain_damage(rows), {r[0] for r in rows})
    assert cr.report(df.where("false")).count() == 0
    gone = result(cr.report(df, gone=F.lit(True)))
    assert all(r[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for r in gone) and len(gone) == 5


def test_long_conversation_streams(spark):
    rows = [(1, k, ("user", "assistant")[k % 2 if k % 7 else 1], f"Turn {k}.") for k in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    (row,) = cr.report(df).collect()
    code = bytes(1 if r[2] == "user" else 2 for r in rows)
    assert (row["cost"], row["audit"]) == cr.cheapest(code)
    got = cr.repair(df).orderBy("position").collect()
    text = "\n".join(f"{r['role']}:{r['text']}" for r in got)
    assert row["repaired_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert [r["role"] for r in got] == ["user", "assistant"] * (len(got) // 2)
