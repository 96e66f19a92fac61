"""Conversation repair against an exhaustive search and against a plain table of all states."""
import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest

from estatelens.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, part long, pos long, whole string"
LAWFUL = re.compile(r"(s?(ua)+)?")


def damage(rows):
    out = {}
    for c, turn, role, text in rows:
        if c is None:
            continue
        here = out.setdefault(c, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{c}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        here += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {c: sorted(rs, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, rs in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\v\f\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """All states by position, each with its least (cost, audit, repaired)."""
    bad = faults(rows)
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    now = {"": (0, "", ())}

    def put(table, state, cost, audit, lines):
        if state not in table or (cost, audit) < table[state][:2]:
            table[state] = (cost, audit, lines)

    def inserts(table):
        for _ in range(4):
            for state, (cost, audit, lines) in list(table.items()):
                for role in ("user", "assistant"):
                    if role[0] in step[state]:
                        put(table, step[state][role[0]], cost + 2, audit + "I", (*lines, f"{role}:"))
        return table

    for (_, role, text), fault in zip(rows, bad):
        after = {}
        for state, (cost, audit, lines) in inserts(now).items():
            put(after, state, cost + 3, audit + "D", lines)
            if fault in ("blank", "duplicate"):
                continue
            cut = fault == "truncated"
            if role[:1] in step[state]:
                put(after, step[state][role[:1]], cost + cut, audit + "K", (*lines, f"{role}:{text}"))
            for to in ("user", "assistant"):
                if to[0] in step[state]:
                    put(after, step[state][to[0]], cost + cut + 2, audit + "R", (*lines, f"{to}:{text}"))
        now = after
    return min(v for s, v in inserts(now).items() if s in ("", "a"))


def brute(rows):
    out = {}
    for c, rs in damage(rows).items():
        bad = faults(rs)
        turns = {t for t, _, _ in rs} - {None}
        cost, audit, lines = cheapest(rs)
        pairs = [x[1][:1] + y[1][:1] for x, y in zip(rs, rs[1:])]
        out[c] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, bad.count("blank"), bad.count("duplicate"), bad.count("truncated"),
                  sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def results(df):
    return {r["conv_id"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], r["repaired_sha256"]) for r in df.collect()}


def corpus():
    r = np.random.default_rng(8)
    roles = ["user", "assistant", "system", "tool", None, "", "uncle"]
    texts = ["Yes.", "No!", "cut off", "", " \t\n", None, "Ja? \n", "é。", "Yes.", "a.b", "fine.  "]
    rows = []
    for c in range(300):
        for t in range(int(r.integers(1, 9))):
            role = ("user", "assistant")[t % 2] if r.random() < 0.6 else roles[int(r.integers(len(roles)))]
            rows.append((c, None if r.random() < 0.05 else int(t + (r.random() < 0.1) * 5), role, texts[int(r.integers(len(texts)))] if r.random() < 0.5 else f"text {t}."))
    rows += [(400, t, roles[int(r.integers(3))], f"turn {int(r.integers(60))}" + "." * int(r.integers(2))) for t in range(1500)]
    rows += [(401, int(t // 3), roles[int(r.integers(4))], f"t {int(r.integers(400))}.") for t in range(700)]
    rows += [(None, 1, "user", "no id."), (402, 1, "user", "x" * 100_000 + "."), (402, 2, "assistant", "same."), (402, 2, "assistant", "same."), (-5, 0, "user", "Hi.")]
    gone = next(c for c in range(500, 900) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return rows + [(gone, 0, "user", "dropped.")]


def test_edits_are_the_cheapest_of_all_and_ascii_least():
    """Every edit sequence with up to one insert before each row and two at the end, for short conversations."""
    r = np.random.default_rng(2)
    for _ in range(60):
        n = int(r.integers(0, 5))
        rows = [(int(r.integers(4)), bool(r.random() < 0.2), bool(r.random() < 0.3)) for _ in range(n)]
        rows = [(i, g, c and not g) for i, g, c in rows]
        best = []
        for choice in itertools.product(*[[(k, e) for k in range(2) for e in "DKRr"] for _ in rows], range(3)):
            for first in "ua":
                shown, cost, audit, turn = "", 0, "", first
                for (inserts, e), (initial, gone, cut) in zip(choice, rows):
                    for _ in range(inserts):
                        shown += "a" if shown.endswith("u") else "u"
                    letter = {"D": "", "K": "sua?"[initial], "R": "u", "r": "a"}[e]
                    cost += 2 * inserts + {"D": 3, "K": cut, "R": 2 + cut, "r": 2 + cut}[e] + (1000 if gone and e != "D" else 0)
                    shown += letter
                    audit += "I" * inserts + e.upper()
                for _ in range(choice[-1]):
                    shown += "a" if shown.endswith("u") else "u"
                if LAWFUL.fullmatch(shown):
                    best.append((cost + 2 * choice[-1], audit + "I" * choice[-1]))
        audit, state = repair.edits(rows, 0, repair.ENDS)
        audit += repair.closing(state)
        assert (repair.cost_of(audit, rows), audit) == min(best)


def test_recursion_equals_one_table():
    r = np.random.default_rng(4)
    for n in (0, 1, 15, 16, 17, 33, 200, 1000):
        rows = [(1 if r.random() < 0.3 else int(r.integers(4)), bool(r.random() < 0.1), bool(r.random() < 0.3)) for _ in range(n)]
        got, end = repair.edits(rows, 0, repair.ENDS)
        saved, repair.LEAF = repair.LEAF, 10 ** 9
        try:
            assert (got, end) == repair.edits(rows, 0, repair.ENDS)
        finally:
            repair.LEAF = saved
        assert repair.cost_of(got + repair.closing(end), rows) == repair.backward(rows, repair.ENDS)[0]


@pytest.mark.parametrize("parts, part_rows, part_chars", [(1, 2048, 4_000_000), (8, 50, 4_000_000), (5, 3, 200)])
def test_equals_brute_force(spark, parts, part_rows, part_chars):
    rows = corpus()
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        df = spark.createDataFrame([(*r, 1, 2, "w") for r in rows], SCHEMA).repartition(3)
        got = results(repair.repaired(df, part_rows, part_chars))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert got == brute(rows)


def test_repaired_text_follows_the_law(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, 2, "w") for r in rows], SCHEMA)
    for r in repair.repaired(df).where("repaired IS NOT NULL AND conv_id < 300").collect():
        shown = "".join(line[:1] for line in r["repaired"].split("\n")) if r["repaired"] else ""
        if "\n\n" not in r["repaired"] and not re.search(r"\n[^uas]", r["repaired"]):
            assert LAWFUL.fullmatch(shown), r


def test_empty(spark):
    assert repair.repaired(spark.createDataFrame([], SCHEMA)).count() == 0
