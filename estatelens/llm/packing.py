"""Packing token sequences by cutting-stock column generation.

Documents are tokenised in Arrow batches and cut into full sequences and one remainder each. Remainders are classed by
length in steps of ``UNIT`` tokens; those of up to ``SHORT`` tokens by their exact length, and a cutting-stock program of its own
puts them into bundles of up to ``BUNDLE`` tokens, which go on as pieces. Over the histogram of classes (at most
``CAPACITY`` / ``UNIT`` numbers, whatever the data) a linear program chooses how often to use which pattern of classes; a knapsack dynamic program over the duals
prices new patterns until none improves. Solutions are rounded down and what is left is packed first-fit decreasing.
The pieces of a class are ranked in hash order, in parts, and a rank gives the pattern, its copy and the place in it.

Edge cases: a null text counts as empty and an empty text is its end id alone; very long texts fill whole sequences;
repeated rows are packed each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import running, ship, staged
from .tokens import Encoder

ship(__name__)

CAPACITY = 2048
UNIT = 8
SHORT = 64
BUNDLE = 512
END_ID = 1
GAP = 1e-3  # the linear program is solved to this distance from its bound
BATCH_CHARS = 4_000_000
PARTS = 256


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def tokenized(docs: DataFrame, id_col: str, text: str, path: str, capacity: int, with_ids: bool) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, and the ids where asked for."""
    end = np.array([END_ID], "<u4").tobytes()
    own = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    fields = [own.schema["id"], *[T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")], *([T.StructField("ids", T.BinaryType())] if with_ids else [])]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            texts, at = [t or "" for t in batch.column(1).to_pylist()], 0
            while at < len(texts):
                chars, to = 0, at
                while to < len(texts) and (to == at or chars + len(texts[to]) <= BATCH_CHARS):
                    chars, to = chars + len(texts[to]), to + 1
                rows = []
                for k, ids in enumerate(encoder.batch(texts[at:to]), at):
                    ids += end
                    for a in range(0, len(ids), 4 * capacity):
                        piece = ids[a:a + 4 * capacity]
                        rows.append((k, a // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4, piece))
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(columns[0], pa.int64())), *[pa.array(c, pa.int64()) for c in columns[1:5]], *([pa.array(columns[5], pa.binary())] if with_ids else [])],
                    names=[f.name for f in fields])
                at = to

    return own.mapInArrow(cut, T.StructType(fields))


def _best_pattern(value: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The most valuable multiset of sizes within the capacity (unbounded knapsack).

    A size that smaller ones fill at no less value is never used, so only the few others are tried at each capacity.
    """
    best, choice, useful = [0.0] * (capacity + 1), [-1] * (capacity + 1), []
    at = {s: k for k, s in enumerate(sizes.tolist())}
    worth = value.tolist()
    for c in range(1, capacity + 1):
        top, by = best[c - 1] + 1e-12, -1
        for s, v, k in useful:
            total = v + best[c - s]
            if total > top:
                top, by = total, k
        k = at.get(c)
        if k is not None and worth[k] > top:
            top, by = worth[k], k
            useful.append((c, worth[k], k))
        best[c], choice[c] = (top, by) if by >= 0 else (best[c - 1], -1)
    pattern, c = np.zeros(len(sizes), np.int64), capacity
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            pattern[choice[c]] += 1
            c -= int(sizes[choice[c]])
    return pattern


def cutting_stock(demand: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(pattern, copies) that cover the demand per size; a pattern maps sizes to how often it holds them."""
    sizes = np.array(sorted(demand), np.int64)
    if not len(sizes):
        return []
    need = np.array([demand[s] for s in sizes.tolist()], float)
    fill = capacity // sizes
    basis, inverse = np.diag(fill).astype(np.int64), np.diag(1.0 / fill)
    amount = inverse @ need
    for _ in range(40 * len(sizes)):  # any basis on the way covers the demand
        entering = _best_pattern(inverse.sum(axis=0), sizes, capacity)
        if inverse.sum(axis=0) @ entering <= 1 + GAP:
            break
        step = inverse @ entering
        ratio = np.where(step > 1e-9, amount / np.where(step > 1e-9, step, 1.0), np.inf)
        out = int(np.argmin(ratio))
        amount = np.maximum(amount - ratio[out] * step, 0.0)
        amount[out] = ratio[out]
        pivot = inverse[out] / step[out]
        inverse -= np.outer(step, pivot)
        inverse[out] = pivot
        basis[:, out] = entering
    copies = np.floor(amount + 1e-6).astype(np.int64)
    left = need.astype(np.int64)
    out = []
    for j in np.flatnonzero(copies):
        pattern = basis[:, j]
        n = int(min([copies[j], *(left[pattern > 0] // pattern[pattern > 0])]))
        if n > 0:
            left -= n * pattern
            out.append((pattern, n))
    while left.any():
        room, pattern = capacity, np.zeros(len(sizes), np.int64)
        for i in range(len(sizes) - 1, -1, -1):
            pattern[i] = min(left[i], room // sizes[i])
            room -= pattern[i] * sizes[i]
        n = int((left[pattern > 0] // pattern[pattern > 0]).min())
        left -= n * pattern
        out.append((pattern, n))
    return [({int(sizes[i]): int(p[i]) for i in np.flatnonzero(p)}, n) for p, n in out]


def _plan(demand: dict[int, int], capacity: int) -> tuple[dict[int, list], int]:
    """For each size the ranges of ranks (first, last, per bin, first bin), and the number of bins."""
    plan: dict[int, list] = {c: [] for c in demand}
    used, base = dict.fromkeys(demand, 0), 0
    for pattern, n in cutting_stock(demand, capacity):
        for c, per in pattern.items():
            plan[c].append((used[c], used[c] + per * n, per, base))
            used[c] += per * n
        base += n
    return plan, base


def packed(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ``ids`` (little-endian
    unsigned 32-bit) with ``with_ids``."""
    spark = docs.sparkSession
    pieces = tokenized(docs, id_col, text, path or vocabulary(), capacity, with_ids)
    short = F.col("length") <= SHORT
    pieces = staged(pieces.withColumn("_class", F.when(short, -F.col("length")).otherwise(F.ceil(F.col("length") / UNIT)).cast("int")).withColumn("_mix", F.xxhash64("id", "start", "ids_crc32")), "pack-pieces")
    demand = {r["_class"]: r["n"] for r in pieces.groupBy("_class").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most SHORT + capacity / UNIT rows
    bundle = min(BUNDLE, capacity) // UNIT
    inner, bundles = _plan({-c: n for c, n in demand.items() if c < 0}, bundle * UNIT)
    long = {c: n for c, n in demand.items() if c > 0}
    own = long.get(bundle, 0)
    outer, _ = _plan(long | ({bundle: own + bundles} if bundles else {}), capacity // UNIT)
    place = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("first", "last", "per", "base")]))
    rules = spark.createDataFrame([(c, inner[-c] if c < 0 else None, outer[bundle if c < 0 else c], own if c < 0 else 0) for c in demand],
                                  T.StructType([T.StructField("_class", T.IntegerType()), T.StructField("_inner", place), T.StructField("_outer", place), T.StructField("_own", T.LongType())]))
    ranked = running(pieces.withColumn("_part", F.pmod("_mix", F.lit(PARTS))), ["_class"], "_part", ["_mix", "id", "start", "ids_crc32"], {}, "_rank")
    ranked = ranked.join(F.broadcast(rules), "_class")

    def placed(plan: str, rank: Column) -> tuple[Column, Column]:
        """The bin of a rank and the place in it."""
        at = F.element_at(F.filter(plan, lambda p: (p["first"] <= rank) & (rank < p["last"])), 1)
        return at["base"] + F.floor((rank - at["first"]) / at["per"]), (rank - at["first"]) % at["per"]

    b, slot = placed("_inner", F.col("_rank"))
    ranked = ranked.withColumns({"_b": F.when(F.col("_inner").isNotNull(), b), "_slot": slot})
    ranked = ranked.withColumn("_at", F.coalesce(F.col("_own") + F.col("_b"), F.col("_rank")))
    sequence, place_in = placed("_outer", F.col("_at"))
    ranked = ranked.withColumns({"sequence_id": sequence, "_place": place_in})
    size = F.when(F.col("_class") > 0, F.col("_class")).otherwise(bundle)
    before = Window.partitionBy("sequence_id").orderBy(F.desc(size), "_place", F.asc("_class"), "_slot").rowsBetween(Window.unboundedPreceding, -1)
    out = ranked.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    return out.select(F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else []))
