"""Cheapest edits that give a conversation the order (system) (user assistant)..., by Hirschberg's divide and conquer.

A conversation is read by an automaton of four states: nothing yet, after a system turn, after user, after assistant. A
row is kept, given the role that the state asks for, or deleted, and turns may be inserted anywhere; the costs are those
of ``EDITS``. A vector holds the least cost for each state: forwards from the start, backwards from the end, with inserts
before a row counted to that row. ``edits`` halves a conversation, lets both vectors meet in the middle, keeps the
crossings whose sum is optimal, solves the left half towards them, which takes the ASCII-least edits, and the right half
from the crossing reached. Its space is linear in the rows' flags, and vectors are kept for ``LEAF`` rows at a time only.

Rows are range-partitioned by conversation and turn and sorted. A conversation inside one partition is repaired where it
lies. One that crosses a partition, at most two for each, or that is longer than ``PART_ROWS`` rows, goes on as parts of
bounded size: each part is summed up in a 4 x 4 matrix of least costs, the matrices (one short row a part) are scanned from the
end for the vector behind each part, each part then maps every entry state to its exit state, these maps are scanned from
the start, and every part is repaired from its own entry state. So no task holds a long conversation, and its result
equals that of one recursion. SHA-256 of repaired text is sequential by definition and is fed one part at a time.

Edge cases: rows without conv_id take no part; rows of one turn are ordered by role and text; a role without a first
letter, or with another than s, u or a, cannot be kept; repeated rows are duplicates; a conversation without rows after damage has
zeros, no edits and no text; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, staged

ship(__name__)

LEAF = 16
PART_ROWS = 2048
PART_CHARS = 4_000_000
EDITS = {"D": 3, "I": 2, "K": 0, "R": 2}  # an undeleted truncated row costs 1 more
FAR = 1 << 60
NEXT = (2, 2, 3, 2)  # the state after the turn that a state asks for
ASKED = ("user", "user", "assistant", "user")
KEPT = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})  # by initial (system, user, assistant, other): from state, to state
LEGAL = {(0, 1), (1, 2), (2, 1)}
ENDS = (0, 4, 2, 0)  # least cost from a state to a lawful end
START = (0, FAR, FAR, FAR)

# a row's flags: (initial, must be deleted, truncated)
Flags = tuple[int, bool, bool]


def _before(row: Flags, after: tuple) -> tuple:
    """The backward vector before a row, inserts included, from the one behind it."""
    initial, gone, cut = row
    out = [3 + v for v in after]
    if not gone:
        keep = KEPT[initial]
        for s in range(4):
            cost = 2 + cut + after[NEXT[s]]
            if cost < out[s]:
                out[s] = cost
            if s in keep and cut + after[keep[s]] < out[s]:
                out[s] = cut + after[keep[s]]
    u, a = min(out[2], 2 + out[3], 4 + out[2]), min(out[3], 2 + out[2])
    return min(out[0], 2 + u), min(out[1], 2 + u), u, a


def _after(row: Flags, before: tuple) -> tuple:
    """The forward vector behind a row from the one before it; inserts between rows come before the second."""
    initial, gone, cut = row
    v = list(before)
    u, a = min(v[2], 2 + min(v[0], v[1], v[3])), v[3]
    a = min(a, 2 + u)
    v[2], v[3] = min(u, 2 + a), a
    out = [3 + x for x in v]
    if not gone:
        for s in range(4):
            out[NEXT[s]] = min(out[NEXT[s]], 2 + cut + v[s])
        for s, to in KEPT[initial].items():
            out[to] = min(out[to], cut + v[s])
    return tuple(out)


def backward(rows: list[Flags], after: tuple) -> tuple:
    for row in reversed(rows):
        after = _before(row, after)
    return after


def edits(rows: list[Flags], state: int, after: tuple) -> tuple[str, int]:
    """The ASCII-least of the cheapest edits from ``state`` towards the backward vector ``after``, and the state reached."""
    if len(rows) <= LEAF:
        vectors = [after]
        for row in reversed(rows):
            vectors.append(_before(row, vectors[-1]))
        out = []
        for row in rows:
            here, behind = vectors.pop(), vectors[-1]
            initial, gone, cut = row
            while True:
                goal = here[state]
                if 3 + behind[state] == goal:
                    out.append("D")
                    break
                if 2 + here[NEXT[state]] == goal:
                    out.append("I")
                    state = NEXT[state]
                    continue
                to = KEPT[initial].get(state)
                if to is not None and cut + behind[to] == goal:
                    out.append("K")
                    state = to
                else:
                    out.append("R")
                    state = NEXT[state]
                break
        return "".join(out), state
    half = len(rows) // 2
    left, right = rows[:half], rows[half:]
    forward = tuple(0 if s == state else FAR for s in range(4))
    for row in left:
        forward = _after(row, forward)
    middle = backward(right, after)
    best = min(f + b for f, b in zip(forward, middle))
    first, crossing = edits(left, state, tuple(b if f + b == best else FAR for f, b in zip(forward, middle)))
    rest, state = edits(right, crossing, after)
    return first + rest, state


def closing(state: int) -> str:
    """Inserts that end a conversation lawfully."""
    out = ""
    while state in (1, 2):
        out, state = out + "I", NEXT[state]
    return out


def cost_of(audit: str, rows: list[Flags]) -> int:
    cuts = iter(cut for _, _, cut in rows)
    return sum(EDITS[e] + (next(cuts) and e != "D" if e != "I" else 0) for e in audit)


def lines(audit: str, state: int, turns: list[tuple[str, str]]) -> list[str]:
    """role:text of the rows that edits leave, from an entry state."""
    out, rows = [], iter(turns)
    for e in audit:
        role, text = next(rows) if e != "I" else ("", "")
        if e == "D":
            continue
        if e != "K":
            role = ASKED[state]
        out.append(f"{role}:{text}")
        state = KEPT["sua".index(role[:1])][state]
    return out


def matrix(rows: list[Flags]) -> list[int]:
    """Least cost from each state before to each state behind some rows, state by state."""
    columns = [backward(rows, tuple(0 if s == e else FAR for s in range(4))) for e in range(4)]
    return [columns[e][s] for s in range(4) for e in range(4)]


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after damage, with each row's flags; nulls are one blank, also in the damage's key."""
    blank = F.lit(" ")
    key = F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
        (F.crc32(key.cast("binary")) % 20).cast("int").alias("_kind")).where(F.col("_kind") != 0)
    kind = F.col("_kind")
    rows = rows.withColumns({
        "role": F.when(kind == 4, F.lit("user")).otherwise(F.col("role")),
        "text": F.when(kind == 1, F.lit("")).when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")),
        "_copy": F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))})
    initial = F.instr(F.lit("sua"), F.substring("role", 1, 1))
    return rows.select("conv_id", "turn", "role", "text",
                       F.when((F.length("role") > 0) & (initial > 0), initial - 1).otherwise(3).alias("initial"),
                       (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"), (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"),
                       F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit("second"), "text", "role").alias("b"))


COUNTS = "blank long, duplicate long, truncated long, illegal long"
ROW = "struct<part:long,pos:long,turn:long,role:string,text:string,initial:int,blank:boolean,cut:boolean,a:long,b:long>"
WHOLE = "struct<gaps:long,blank:long,duplicate:long,truncated:long,illegal:long,cost:long,audit:string,repaired:string>"
ROW_TYPE = pa.struct([("part", pa.int64()), ("pos", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("initial", pa.int32()), ("blank", pa.bool_()), ("cut", pa.bool_()), ("a", pa.int64()), ("b", pa.int64())])
WHOLE_TYPE = pa.struct([(k, pa.int64()) for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string()), ("repaired", pa.string())])


def _flags(rows: list[dict]) -> list[Flags]:
    return [(r["initial"], r["blank"] or r["again"], r["cut"] and not (r["blank"] or r["again"])) for r in rows]


def _counted(rows: list[dict]) -> dict:
    again = [r["again"] and not r["blank"] for r in rows]
    return {"blank": sum(r["blank"] for r in rows), "duplicate": sum(again), "truncated": sum(r["cut"] and not (r["blank"] or r["again"]) for r in rows),
            "illegal": sum((x["initial"], y["initial"]) not in LEGAL for x, y in zip(rows, rows[1:]))}


def whole(rows: list[dict]) -> dict:
    """The result of one conversation whose rows are all here, in order."""
    seen: set = set()
    for r in rows:
        r["again"] = (r["role"], r["text"]) in seen
        seen.add((r["role"], r["text"]))
    flags = _flags(rows)
    audit, state = edits(flags, 0, ENDS)
    audit += closing(state)
    turns = {r["turn"] for r in rows} - {None}
    return {"gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, **_counted(rows), "cost": cost_of(audit, flags), "audit": audit,
            "repaired": "\n".join(lines(audit, 0, [(r["role"], r["text"]) for r in rows]))}


def _inside(part_rows: int, part_chars: int) -> Callable:
    """Sorted rows of a partition to results of the conversations inside it and numbered rows of the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        part, pos, filled = base, base, 0
        held, chars, edge, conv = [], 0, True, None

        def batch(ids, results, rows):
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(results, WHOLE_TYPE), pa.array(rows, ROW_TYPE)], ["conv_id", "whole", "row"])

        def numbered(rows):
            nonlocal part, pos, filled
            for r in rows:
                size = 1 + part_rows * len(r["text"]) // part_chars
                if filled and filled + size > part_rows:
                    part, filled = part + 1, 0
                filled += size
                r["part"], r["pos"] = part, pos
                pos += 1
            return batch([r["conv_id"] for r in rows], [None] * len(rows), rows)

        for b in batches:
            done, results = [], []
            for r in b.to_pylist():
                if r["conv_id"] != conv:
                    if held:
                        if edge:
                            yield numbered(held)
                            part, filled = part + 1, 0
                        else:
                            done.append(conv)
                            results.append(whole(held))
                    elif conv is not None:
                        part, filled = part + 1, 0
                    edge = conv is None
                    held, chars, conv = [], 0, r["conv_id"]
                held.append(r)
                chars += len(r["text"])
                if len(held) >= part_rows or chars >= part_chars:  # too long to wait for its end
                    edge = True
                    yield numbered(held)
                    held, chars = [], 0
            if done:
                yield batch(done, results, [None] * len(done))
        if held:
            yield numbered(held)

    return run


def _long(rows: DataFrame) -> DataFrame:
    """Results of conversations in parts: ``rows`` are conv_id and the fields of ``ROW``."""
    key = ["conv_id", "part"]
    local = rows.groupBy(*key, "a", "b").agg(F.min("pos").alias("pos"))
    first = local.groupBy("conv_id", "a", "b").agg(F.min("pos").alias("pos")).select("pos", F.lit(False).alias("again"))
    rows = staged(rows.join(first, "pos", "left").withColumn("again", F.coalesce("again", F.lit(True))), "repair-rows")
    codes = rows.select(*key, "pos", "turn", "initial", "blank", "again", "cut")

    def ordered(table: pa.Table) -> list[dict]:
        return table.sort_by("pos").to_pylist()

    def summary(table: pa.Table) -> pa.Table:
        r = ordered(table)
        turns = [x["turn"] for x in r if x["turn"] is not None]
        return pa.Table.from_pylist([{"conv_id": r[0]["conv_id"], "part": r[0]["part"], "least": matrix(_flags(r)), **_counted(r), "first": r[0]["initial"], "last": r[-1]["initial"],
                                      "low": min(turns, default=None), "high": max(turns, default=None), "turns": len(set(turns))}],
                                    pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("least", pa.list_(pa.int64())), *[(k, pa.int64()) for k in ("blank", "duplicate", "truncated", "illegal")],
                                               ("first", pa.int32()), ("last", pa.int32()), ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64())]))

    parts = staged(codes.groupBy(*key).applyInArrow(summary, f"conv_id long, part long, least array<long>, {COUNTS}, first int, last int, low long, high long, turns long"), "repair-parts")

    def behind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, vector = None, ENDS
        for b in batches:
            out = []
            for c, p, m in zip(*(b.column(k).to_pylist() for k in range(3))):
                if c != conv:
                    conv, vector = c, ENDS
                    last = True
                out.append({"conv_id": c, "part": p, "after": list(vector), "final": last})
                vector, last = tuple(min(min(m[4 * s + e] + vector[e] for e in range(4)), FAR) for s in range(4)), False
            if out:
                yield pa.RecordBatch.from_pylist(out)

    vectors = staged(parts.select(*key, "least").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part")).mapInArrow(
        behind, "conv_id long, part long, after array<long>, final boolean"), "repair-vectors")

    def exits(table: pa.Table) -> pa.Table:
        r = ordered(table)
        flags, after = _flags(r), tuple(r[0]["after"])
        reach = [edits(flags, s, after)[1] if backward(flags, after)[s] < FAR else s for s in range(4)]
        return pa.table({"conv_id": [r[0]["conv_id"]], "part": [r[0]["part"]], "exits": pa.array([reach], pa.list_(pa.int32()))})

    maps = codes.join(vectors, key).groupBy(*key).applyInArrow(exits, "conv_id long, part long, exits array<int>")

    def entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, last, high = None, 0, None, None
        for b in batches:
            out = []
            for x in b.to_pylist():
                if x["conv_id"] != conv:
                    conv, state, last, high = x["conv_id"], 0, None, None
                out.append({"conv_id": conv, "part": x["part"], "entry": state, "broken": int(last is not None and (last, x["first"]) not in LEGAL),
                            "shared": int(high is not None and high == x["low"])})
                state, last, high = x["exits"][state], x["last"], x["high"] if x["high"] is not None else high
            if out:
                yield pa.RecordBatch.from_pylist(out)

    entries = staged(parts.select(*key, "first", "last", "low", "high").join(maps, key).repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(
        entered, "conv_id long, part long, entry long, broken long, shared long"), "repair-entries")

    def repaired(table: pa.Table) -> pa.Table:
        r = ordered(table)
        flags, state = _flags(r), r[0]["entry"]
        audit, end = edits(flags, state, tuple(r[0]["after"]))
        if r[0]["final"]:
            audit += closing(end)
        left = lines(audit, state, [(x["role"], x["text"]) for x in r])
        return pa.table({"conv_id": [r[0]["conv_id"]], "part": [r[0]["part"]], "cost": [cost_of(audit, flags)], "audit": [audit], "n_lines": [len(left)], "repaired": ["\n".join(left)]})

    pieces = staged(rows.join(vectors, key).join(entries, key).groupBy(*key).applyInArrow(
        repaired, "conv_id long, part long, cost long, audit string, n_lines long, repaired string"), "repair-pieces")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, sha, audit, some = None, None, [], False

        def done():
            return pa.RecordBatch.from_pylist([{"conv_id": conv, "audit": "".join(audit), "repaired_sha256": sha.hexdigest()}])

        for b in batches:
            for x in b.to_pylist():
                if x["conv_id"] != conv:
                    if conv is not None:
                        yield done()
                    conv, sha, audit, some = x["conv_id"], hashlib.sha256(), [], False
                audit.append(x["audit"])
                if x["n_lines"]:
                    sha.update((b"\n" if some else b"") + x["repaired"].encode())
                    some = True
        if conv is not None:
            yield done()

    texts = pieces.select("conv_id", "part", "audit", "n_lines", "repaired").repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(joined, "conv_id long, audit string, repaired_sha256 string")
    counts = parts.join(entries, key).join(pieces.select(*key, "cost"), key).groupBy("conv_id").agg(
        F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("turns") + F.sum("shared"), F.lit(0)).alias("gaps"), *[F.sum(k).alias(k) for k in ("blank", "duplicate", "truncated")],
        F.sum(F.col("illegal") + F.col("broken")).alias("illegal"), F.sum("cost").alias("cost"))
    return counts.join(texts, "conv_id")


def repaired(conversations: DataFrame, part_rows: int = PART_ROWS, part_chars: int = PART_CHARS) -> DataFrame:
    """Per conversation: gaps, faults, cost and audit of the cheapest repair, the repaired text's SHA-256, and the text
    itself where the conversation lies in one part."""
    rows = damaged(conversations)
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    sorted_rows = rows.repartitionByRange("conv_id", *order).sortWithinPartitions("conv_id", *order)
    sides = staged(sorted_rows.mapInArrow(_inside(part_rows, part_chars), f"conv_id long, whole {WHOLE}, row {ROW}"), "repair-sides")
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256", "repaired"]
    inside = sides.where(F.col("whole").isNotNull()).select("conv_id", "whole.*").withColumn("repaired_sha256", F.sha2("repaired", 256)).select(*names)
    across = _long(sides.where(F.col("row").isNotNull()).select("conv_id", "row.*")).withColumn("repaired", F.lit(None).cast("string")).select(*names)
    every = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    out = every.join(inside.unionByName(across), "conv_id", "left")
    empty: Column = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select("conv_id", *[F.coalesce(k, F.lit(0)).cast("long").alias(k) for k in names[1:7]], F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", empty).alias("repaired_sha256"), "repaired")
