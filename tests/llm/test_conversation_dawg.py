import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from kestrel.llm import conversation_dawg as C

ROWS = StructType([StructField("conv_id", LongType()), StructField("turn", LongType()), StructField("role", StringType()),
                   StructField("text", StringType()), StructField("audit", StringType()), StructField("gaps", StringType())])


def table(spark, rows):
    """Rows with further columns whose names the operator uses itself."""
    return spark.createDataFrame([(*r, "x", "y") for r in rows], ROWS)


def fault(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(" \t\n\v\f\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(rows):
    """(cost, audit, repaired texts): every string of edits with at most two inserts in each gap."""
    faults = fault(rows)
    best = None
    inserts = ["", "I", "II"]
    for gaps in itertools.product(inserts, repeat=len(rows) + 1):
        for picks in itertools.product("DKR", repeat=len(rows)):
            audit = gaps[0] + "".join(p + g for p, g in zip(picks, gaps[1:]))
            cost, at, out, ok = 0, 0, [], True
            for e in audit:
                initials = "".join(r[:1] for r, _ in out)
                want = "assistant" if initials.endswith("u") else "user"
                if e == "I":
                    out.append((want, ""))
                    cost += 3
                    continue
                (role, text), f = rows[at], faults[at]
                at += 1
                if e == "D":
                    cost += 4
                    continue
                ok = ok and f not in ("blank", "duplicate") and (e == "R" or role[:1] in ("s", "u", "a"))
                cost += 3 * (f == "truncated") + 3 * (e == "R")
                out.append((want if e == "R" else role, text))
            if ok and re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out)):
                best = min(best or (cost, audit, out), (cost, audit, out), key=lambda x: x[:2])
    return best


def expected(rows):
    """The contract's columns of (turn, role, text) rows in order."""
    pairs = [(r, t) for _, r, t in rows]
    faults, turns = fault(pairs), [t for t, _, _ in rows if t is not None]
    cost, audit, out = brute(pairs) if rows else (0, "", [])
    illegal = sum((a[:1] + b[:1]) not in ("su", "ua", "au") for (a, _), (b, _) in zip(pairs, pairs[1:]))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))


def conversations(seed, n):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", None, "", "u"]
    texts = ["Yes.", "No", "  ", "", None, "Why?\n", "So it is! ", "and then", "é."]
    return {c: [(c, rng.choice([None, t, t, t, t + 1]), rng.choices(roles, [6, 5, 2, 1, 1, 1, 1])[0], rng.choice(texts))
                for t in range(rng.randint(1, 4))] for c in range(n)}


def answers(df):
    return {r["conv_id"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], r["repaired_sha256"])
            for r in df.collect()}


def test_repair_equals_every_string_of_edits(spark):
    data = conversations(1, 70)
    got = answers(C.repair(C.clean(table(spark, [r for rows in data.values() for r in rows]))))
    for c, rows in data.items():
        spaced = in_order([(t, " " if r is None else r, " " if x is None else x) for _, t, r, x in rows])
        assert got[c] == expected(spaced), rows


def test_query_damage_and_repaired_rows(spark, tmp_path):
    data = conversations(2, 60)
    data[900] = data[901] = []  # filled below: copies and a null id
    data[900] = [(None, 0, "user", "Hello."), (None, 1, "assistant", "Hi."), (None, None, None, None)]
    data[901] = [(901, 1, "user", "Same."), (901, 1, "user", "Same."), (901, 2, "assistant", "Same.")]
    flat = [r for rows in data.values() for r in rows]
    table(spark, flat).write.parquet(str(tmp_path / "conversations.parquet"))
    got = answers(C.conversation_query(spark, str(tmp_path)))
    assert set(got) == {r[0] for r in flat}
    for rows in data.values():
        left = []
        for c, t, role, text in rows:
            kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            left += [(t, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        assert got[rows[0][0]] == expected(in_order(left)), rows
    fixed = {}
    for r in C.repaired(C.damaged(table(spark, flat))).orderBy("conv_id", "place").collect():
        fixed.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
        assert r["place"] == len(fixed[r["conv_id"]]) - 1
    for c, answer in got.items():
        assert answer[-1] == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in fixed.get(c, [])).encode()).hexdigest()


def test_all_rows_dropped_and_empty_table(spark):
    rows = table(spark, [(1, 0, "user", "a."), (1, 1, "assistant", "b.")])
    gone = C.clean(rows).withColumn("copies", F.lit(0))
    assert answers(C.repair(gone)) == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert C.repair(C.clean(rows.where("false"))).collect() == [] and C.repaired(C.clean(rows.where("false"))).collect() == []


def test_nodes_are_built_once_and_long_conversations_end():
    built, real = [], C.node_before
    try:
        C.node_before = lambda *a: built.append(a) or real(*a)
        texts = ["".join(x) for n in range(1, 6) for x in itertools.product("uaS-", repeat=n)]
        plans = list(C.plans_of(iter(sorted(texts, key=lambda t: t[::-1]))))
    finally:
        C.node_before = real
    assert len(built) == len(texts) == len(plans)  # one node an ending
    (_, cost, audit), = C.plans_of(iter(["ua" * 20_000 + "-" + "uA" * 3]))
    assert cost == 4 + 9 and audit == "K" * 40_000 + "D" + "K" * 6


def test_many_copies_of_one_conversation_and_a_long_one(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for c in range(300) for t in range(4)]
    rows += [(1000, t, "user", "x" * 1000 + str(t)) for t in range(3000)]
    got = answers(C.repair(C.clean(table(spark, rows))))
    assert {got[c][6] for c in range(300)} == {"KKKK"} and {got[c][5] for c in range(300)} == {0}
    assert got[1000][3] == 3000 and got[1000][5:7] == (4 * 3000, "D" * 3000)  # dearer to keep than to delete


@pytest.mark.parametrize("symbols, want", [("", (0, "")), ("s", (4, "D")), ("x", (6, "IR")), ("ss", (8, "DD"))])
def test_small_plans(symbols, want):
    (_, cost, audit), = C.plans_of(iter([symbols]))
    assert (cost, audit) == want or cost < want[0]
