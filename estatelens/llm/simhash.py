"""SimHash near-duplicates with a Gray-order hierarchical index over masked bit patterns.

Fingerprints are computed per document in Arrow batches (XXH64 of word shingles, one vote per shingle and bit). The
index works on distinct fingerprints. Its upper nodes are pairs (mask, shared pattern): two fingerprints that differ in
at most ``max_bits`` bits agree on at least one of ``max_bits`` + 1 disjoint masks, so each pair meets below one of them.
A node with more than ``NODE_LIMIT`` members is replaced by its children, whose masks add a part of the remaining bits
in the same way; after ``LEVELS`` levels under 2**20 fingerprints can share a node, whatever the data. Within a node the
members are sorted by Gray rank, runs of ``FANOUT`` of them share a masked pattern, runs of runs likewise, and a search
descends from the top, adding up differences in newly fixed bits and dropping a whole group once they exceed the limit.
Each node returns a spanning forest of its links instead of all pairs, and connected components follow by min-label
propagation with pointer jumping over written tables.

Edge cases: null and empty texts have fingerprint zero, linked like any other; a text shorter than a shingle is one
shingle; rows without id get the component of the others; repeated rows share fingerprint and component; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, staged

ship(__name__)

SHINGLE = 3
MAX_BITS = 2
NODE_LIMIT = 4096
LEVELS = 3
FANOUT = 32
SEED = 42
PAIRS = 1 << 17


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash as a signed integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    parts = map(joined.__getitem__, map(slice, starts, (e - 1 for e in ends[shingle - 1:]))) if len(words) > shingle else (joined,)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), "<u8", n)
    votes = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        votes += np.unpackbits(hashes[at:at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<i8")[0])


def _masks(free: list[int], bits: int) -> list[tuple[int, list[int]]]:
    """``bits`` + 1 disjoint masks over the free bit positions, each with the positions that it leaves free."""
    cuts = [len(free) * k // (bits + 1) for k in range(bits + 2)]
    return [(sum(1 << p for p in free[a:b]), free[:a] + free[b:]) for a, b in zip(cuts, cuts[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _levels(max_bits: int) -> list[list[tuple[int | None, int]]]:
    """For each level the (parent mask, mask) pairs of its nodes."""
    out, nodes = [], [(None, 0, list(range(64)))]
    for _ in range(LEVELS):
        nodes = [(mask if parent is not None or mask else None, mask | m, rest) for parent, mask, free in nodes for m, rest in _masks(free, max_bits)]
        out.append([(None if p is None else _signed(p), _signed(m)) for p, m, _ in nodes])
    return out


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each bit pattern in the Gray code sequence."""
    r = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component labels (smallest positions) after links between a and b."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (label[label] != label).any():
            label = label[label]


def node_links(members: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (centre, member) of the components that the links among ``members`` form.

    At most ``PAIRS`` pairs of query and run are open at a time, and a run whose members all belong to the query's
    component already is not entered, so a node full of near copies costs little more than linking them once.
    """
    x = np.unique(members.astype(np.uint64))
    x = x[np.argsort(gray_rank(x), kind="stable")]
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    tree = [(np.full(len(x), full), x)]  # per level the shared mask and pattern of each run
    while len(tree[-1][1]) > FANOUT:
        mask, pattern = tree[-1]
        heads = np.arange(0, len(mask), FANOUT)
        every, some = np.bitwise_and.reduceat(pattern, heads), np.bitwise_or.reduceat(pattern, heads)
        shared = np.bitwise_and.reduceat(mask, heads) & (every | ~some)
        tree.append((shared, every & shared))
    label = np.arange(len(x))
    at, step = 0, FANOUT
    while at < len(x):
        low, high = [label], [label]  # smallest and largest label below each run
        for _, pattern in tree[1:]:
            heads = np.arange(0, len(low[-1]), FANOUT)
            low, high = [*low, np.minimum.reduceat(low[-1], heads)], [*high, np.maximum.reduceat(high[-1], heads)]
        query = np.arange(at, min(len(x), at + step))
        top = np.arange(len(tree[-1][1]))
        q = np.repeat(query, len(top))
        open_runs = [(len(tree) - 1, q, np.tile(top, len(query)), np.zeros(len(q), np.uint64), np.zeros(len(q), np.int64))]
        while open_runs:
            depth, q, node, fixed, acc = open_runs.pop()
            mask, pattern = tree[depth]
            acc = acc + np.bitwise_count((x[q] ^ pattern[node]) & mask[node] & ~fixed)
            near = (acc <= max_bits) & ~((low[depth][node] == label[q]) & (high[depth][node] == label[q]))
            q, node, acc = q[near], node[near], acc[near]
            if not depth:
                label = _joined(label, q, node)
                continue
            below = len(tree[depth - 1][1])
            for k in range(0, len(q), PAIRS // FANOUT):
                part = slice(k, k + PAIRS // FANOUT)
                child = (node[part][:, None] * FANOUT + np.arange(FANOUT)).ravel()
                real = child < below
                more = [np.repeat(v, FANOUT)[real] for v in (q[part], mask[node[part]], acc[part])]
                open_runs.append((depth - 1, more[0], child[real], more[1], more[2]))
        at, step = at + step, min(2 * step, 512)
    moved = label != np.arange(len(x))
    return x[label[moved]].astype(np.int64), x[moved].astype(np.int64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp) of each document; ``fp`` is the fingerprint as a signed long."""
    @F.pandas_udf("long")
    def fp(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            yield pd.Series([fingerprint(x, shingle) for x in t], dtype="int64")

    return docs.select(F.col(id_col).alias("id"), fp(F.coalesce(F.col(text), F.lit(""))).alias("fp"))


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of fingerprints within ``max_bits`` bits."""
    @F.pandas_udf("array<struct<a:long,b:long>>")
    def search(nodes: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in nodes:
            yield pd.Series([[{"a": int(a), "b": int(b)} for a, b in zip(*node_links(np.asarray(m, np.int64), max_bits))] for m in batch])

    found, members = None, distinct.select("fp", F.lit(None).cast("long").alias("mask"))
    for level, masks in enumerate(_levels(max_bits)):
        of = F.array(*[F.struct(F.lit(p).cast("long").alias("p"), F.lit(m).alias("m")) for p, m in masks])
        below = members.withColumn("_m", F.explode(of)).where(F.col("_m.p").eqNullSafe(F.col("mask")))
        members = below.select("fp", F.col("_m.m").alias("mask"), F.col("fp").bitwiseAND(F.col("_m.m")).alias("pattern"))
        small = members
        if level < LEVELS - 1:
            large = staged(members.groupBy("mask", "pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > NODE_LIMIT).select("mask", "pattern"), "simhash-nodes")
            small = members.join(large, ["mask", "pattern"], "left_anti")
        groups = small.groupBy("mask", "pattern").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
        edges = groups.select(F.explode(search("fps")).alias("e")).select("e.a", "e.b")
        found = edges if found is None else found.union(edges)
        if level < LEVELS - 1:
            members = members.join(large, ["mask", "pattern"], "left_semi").select("fp", "mask")
    return found


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of an edge list; all nodes of a component share a root."""
    both = staged(edges.union(edges.select("b", "a")).distinct(), "simhash-edges")
    labels = staged(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")), "simhash-labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("m"))
        hooked = staged(labels.join(near, "node").select("node", "root", F.least("root", "m").alias("next")), "simhash-hooked")
        jump = hooked.select(F.col("node").alias("next"), F.col("next").alias("far"))
        after = staged(hooked.join(jump, "next").select("node", "root", F.least("next", "far").alias("after")), "simhash-labels")
        labels = after.select("node", F.col("after").alias("root"))
        if not after.where(F.col("after") != F.col("root")).limit(1).count():
            return labels


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(id, fp, component): one row per document; ``component`` is the smallest id that links reach."""
    fps = staged(fingerprints(docs, id_col, text, shingle), "simhash-fp")
    distinct = staged(fps.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    roots = components(links(distinct, max_bits))
    placed = distinct.join(roots, distinct["fp"] == roots["node"]).select("fp", "first", "root")
    least = placed.groupBy("root").agg(F.min("first").alias("component"))
    linked = placed.join(least, "root").select("fp", "component")
    to = distinct.join(linked, "fp", "left").select("fp", F.coalesce("component", "first").alias("component"))
    return fps.join(to, "fp").select("id", "fp", "component")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component, the one with the smallest id, with all its columns. Rows without an id cannot
    stand for a group and stay; of repeated rows with one id one stays."""
    named = docs.where(F.col("doc_id").isNotNull())
    chosen = near_duplicates(named, shingle=shingle, max_bits=max_bits).select(F.col("component").alias("_keep")).distinct()
    kept = named.join(chosen, named["doc_id"] == chosen["_keep"], "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))
