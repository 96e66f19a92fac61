"""Prefix trie of conversations in minimal-perfect-hash node tables.

Every prefix of a conversation gets a 128-bit digest: the lanes of its turns' hashes, each taken together with the turn's
position, summed. A sum over a prefix is a running sum, so a conversation of any length is dealt out in range-partitioned
pieces and no task holds it whole (``common.running``). Nodes are the distinct digests; their groups are aggregated
partially, and equal digests with unequal parents or last turns stop the job (verified collisions).

The tree is cut into bounded fragments. A node starts a fragment if its depth is 1 modulo ``BAND`` or its parent has more
than ``HEAVY`` members; so a fragment has at most ``HEAVY`` * ``BAND`` nodes, whatever a first turn's share, and a long
conversation is cut into bands. Fragments are hashed to shards of about ``SHARD_NODES`` nodes. A shard is a node table:
a minimal perfect hash over its digests gives each node a slot, checked against the digest stored there; counts are
scattered into flat numpy arrays by slot, and leaves and savings are accumulated through the array of parent slots,
deepest nodes first. What a fragment adds to the nodes above it is known before: the fragments' own tree, one row per
fragment, is summed by doubling ancestors, in as many rounds as the logarithm of its depth.

The member lists' SHA-256 is sequential by definition. Ids are range-partitioned by (node, id), joined into blocks of up
to ``ID_BLOCK`` ids, and only blocks, not rows, meet in the task that feeds a node's digest, one block at a time.

Edge cases: rows without conv_id take no part; the remainder of a negative id is negative, as in SQL; turns that tie are ordered by the hashes of role and text; repeated rows
are turns like any other; a null role or text is empty; an empty table gives an empty result, without a root; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import running, ship, staged, text_of

ship(__name__)

FAMILY = 100  # conversations of one hundred share the start of their first one
HEADS = 6  # up to HEADS - 1 shared turns
BAND = 16
HEAVY = 20_000
SHARD_NODES = 200_000
ID_BLOCK = 256
SALT = 16

MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def head_length(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def _turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, a, b, chars, piece): each row's position from 1 and the two hashes of its role and text."""
    role, text = text_of("role"), text_of("text")
    narrow = staged(conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.xxhash64(role, text).alias("a"),
        F.xxhash64(F.lit("second"), text, role).alias("b"), F.length(text).cast("long").alias("chars")), "trie-turns")
    order = [F.col("turn").asc_nulls_first(), F.col("a"), F.col("b")]
    dealt = staged(narrow.repartitionByRange("conv_id", *order).withColumn("piece", F.spark_partition_id()), "trie-pieces")
    ranked = running(dealt, ["conv_id"], "piece", order, {}, "before")
    return staged(ranked.select("conv_id", (F.col("before") + 1).alias("pos"), "a", "b", "chars", "piece"), "trie-ranked")


def _lanes(pos: Column, a: Column, b: Column) -> dict[str, Column]:
    """Four 32-bit lanes of a turn at a position, as longs that sums over 2**31 turns do not overflow."""
    x, y = F.xxhash64(pos, a, b), F.xxhash64(b, pos, a)
    low = F.lit(0xFFFFFFFF)
    return {"l0": x.bitwiseAND(low), "l1": F.shiftrightunsigned(x, 32), "l2": y.bitwiseAND(low), "l3": F.shiftrightunsigned(y, 32)}


def _digest(lanes: list[Column]) -> list[Column]:
    low = F.lit(0xFFFFFFFF)
    return [F.shiftleft(hi.bitwiseAND(low), 32).bitwiseOR(lo.bitwiseAND(low)) for hi, lo in (lanes[:2], lanes[2:])]


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that start with their family's first turns: ``paths``, one row per conversation and depth from 1
    with the digests of its prefix (g1, g2) and of the one before (p1, p2), and ``ends``, one row per conversation."""
    turns = _turns(conversations)
    first = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < HEADS)).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "a", "b", "chars"))).alias("head"))
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("n")).withColumns(
        {"h": head_length(F.col("conv_id")), "base": F.col("conv_id") - F.col("conv_id") % FAMILY})
    convs = convs.join(first.withColumnRenamed("conv_id", "base"), "base", "left")
    none = F.array().cast("array<struct<pos:bigint,a:bigint,b:bigint,chars:bigint>>")
    head = F.when(F.col("head").isNull() | (F.col("h") == 0), none).otherwise(F.slice("head", F.lit(1), F.greatest(F.col("h"), F.lit(1)).cast("int")))
    convs = convs.withColumn("head", head).withColumn("k", F.size("head").cast("long"))
    convs = staged(convs.withColumn("length", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "trie-convs")

    inner = ["conv_id", "depth", "a", "b", "chars"]
    heads = convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", F.col("t.pos").alias("depth"), "t.a", "t.b", "t.chars", F.lit(-1).alias("piece"))
    # a piece takes the shift of its conversation through one row per (conversation, piece), not through the hot key
    shift = turns.select("conv_id", "piece").distinct().join(convs.select("conv_id", "h", "k"), "conv_id")
    own = turns.join(shift, ["conv_id", "piece"]).where(F.col("pos") > F.col("h")).select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("depth"), "a", "b", "chars", "piece")
    rows = heads.unionByName(own)
    lanes = _lanes(F.col("depth"), F.col("a"), F.col("b"))
    sums = running(rows.withColumns(lanes), ["conv_id"], "piece", ["depth"], {f"s{k}": F.col(f"l{k}") for k in range(4)}, "_rank")
    p = _digest([F.col(f"s{k}") for k in range(4)])
    g = _digest([F.col(f"s{k}") + F.col(f"l{k}") for k in range(4)])
    paths = sums.select(*inner, p[0].alias("p1"), p[1].alias("p2"), g[0].alias("g1"), g[1].alias("g2"))
    return staged(paths, "trie-paths"), convs.select("conv_id", "length")


def _looked_up(rows: DataFrame, key: list[str], table: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``table``, one row per key; rows of a hot key are dealt over ``SALT`` tasks ``by``
    other columns."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(SALT)))
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)).cast("array<bigint>")))
    return salted.join(copies, [*key, "_salt"], how).drop("_salt")


def _totals(fragments: DataFrame) -> DataFrame:
    """Leaves and savings of each fragment together with all fragments below it.

    ``fragments``: f1, f2 (digest of the top node), q1, q2 (the fragment above; zero: the root), leaves, saved. After
    round k a row's sums reach 2**k fragments down, and its pointer as many up.
    """
    now = fragments
    while now.limit(1).count() and now.where((F.col("q1") != 0) | (F.col("q2") != 0)).limit(1).count():
        inner = now.where((F.col("q1") != 0) | (F.col("q2") != 0))
        more = inner.groupBy(F.col("q1").alias("f1"), F.col("q2").alias("f2")).agg(F.sum("leaves").alias("_l"), F.sum("saved").alias("_s"))
        used = more.select(F.col("f1").alias("q1"), F.col("f2").alias("q2"))
        above = now.select(F.col("f1").alias("q1"), F.col("f2").alias("q2"), F.col("q1").alias("r1"), F.col("q2").alias("r2")).join(used, ["q1", "q2"], "left_semi")
        moved = _looked_up(inner.select("f1", "f2", "q1", "q2"), ["q1", "q2"], above, ["f1", "f2"]).select("f1", "f2", "r1", "r2")
        now = staged(now.join(more, ["f1", "f2"], "left").join(moved, ["f1", "f2"], "left").select(
            "f1", "f2", F.coalesce("r1", F.lit(0)).alias("q1"), F.coalesce("r2", F.lit(0)).alias("q2"),
            (F.col("leaves") + F.coalesce("_l", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("_s", F.lit(0))).alias("saved")), "trie-totals")
    return now.select("f1", "f2", "leaves", "saved")


class PerfectHash:
    """Minimal perfect hash over distinct 128-bit keys: bit arrays of keys that are alone in their cell, one per level;
    a key's slot is the rank of its bit. ``find`` checks the key stored at the slot, so unknown keys get -1."""

    def __init__(self, k1: np.ndarray, k2: np.ndarray):
        self.levels: list[tuple[int, np.ndarray]] = []
        left, offset = np.arange(len(k1)), 0
        slots = np.full(len(k1), -1, np.int64)
        while len(left):
            if len(self.levels) > 64:
                raise ValueError("equal digests in a node table")
            size = max(16, 2 * len(left))
            cell = self._cell(k1[left], k2[left], len(self.levels), size)
            alone = np.bincount(cell, minlength=size) == 1
            rank = np.cumsum(alone) - 1 + offset
            hit = alone[cell]
            slots[left[hit]] = rank[cell[hit]]
            self.levels.append((size, np.where(alone, rank, -1)))
            offset += int(alone.sum())
            left = left[~hit]
        self.slots, self.k1, self.k2 = slots, np.empty_like(k1), np.empty_like(k2)
        self.k1[slots], self.k2[slots] = k1, k2

    @staticmethod
    def _cell(k1: np.ndarray, k2: np.ndarray, level: int, size: int) -> np.ndarray:
        x = (k1 ^ np.uint64(MIX[0] * (level + 1) & (1 << 64) - 1)) * np.uint64(MIX[1]) + k2
        x = (x ^ x >> np.uint64(31)) * np.uint64(MIX[2])
        return ((x ^ x >> np.uint64(29)) % np.uint64(size)).astype(np.int64)

    def find(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        slot = np.full(len(k1), -1, np.int64)
        if not len(self.k1):
            return slot
        for level, (size, ranks) in enumerate(self.levels):
            at = ranks[self._cell(k1, k2, level, size)]
            slot = np.where(slot < 0, at, slot)
            right = (slot >= 0) & (self.k1[slot] == k1) & (self.k2[slot] == k2)
            slot = np.where(right, slot, -1)
        return slot


SHARD_OUT = "shard long, slot long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, g1 long, g2 long"


def node_table(nodes: pa.Table) -> pa.Table:
    """The rows of one shard with slots and sums over subtrees; ``more_*`` is what fragments of other shards add."""
    col = {name: nodes[name].to_numpy() for name in nodes.column_names}
    g1, g2 = col["g1"].view(np.uint64), col["g2"].view(np.uint64)
    table = PerfectHash(g1, g2)
    slot = table.slots
    inside = np.where(col["top"], -1, table.find(col["p1"].view(np.uint64), col["p2"].view(np.uint64)))
    if (inside[~col["top"]] < 0).any():
        raise ValueError("a node's parent is missing from its fragment")
    flat = {k: np.zeros(len(slot), np.int64) for k in ("parent", "depth", "children", "leaves", "saved")}
    for k, v in (("parent", inside), ("depth", col["depth"]), ("children", col["more_children"]),
                 ("leaves", (col["n_convs"] == col["n_ends"]) + col["more_leaves"]), ("saved", (col["n_convs"] - 1) * col["chars"] + col["more_saved"])):
        flat[k][slot] = v
    parent = flat["parent"]
    np.add.at(flat["children"], parent[parent >= 0], 1)
    order = np.argsort(-flat["depth"], kind="stable")
    cuts = np.flatnonzero(np.diff(flat["depth"][order])) + 1
    for at in np.split(order, cuts):
        up = at[parent[at] >= 0]
        for k in ("leaves", "saved"):
            np.add.at(flat[k], parent[up], flat[k][up])
    conv = np.empty_like(slot)
    conv[slot] = col["conv_id"]
    above = pa.array(np.where(inside >= 0, conv[inside], col["top_parent"]), mask=col["depth"] == 0)
    out = {"shard": col["shard"], "slot": slot, "conv_id": col["conv_id"], "depth": col["depth"], "parent_conv_id": above, "n_convs": col["n_convs"],
           "n_children": flat["children"][slot], "n_leaves": flat["leaves"][slot], "saved_tokens": flat["saved"][slot], "g1": col["g1"], "g2": col["g2"]}
    return pa.table(out)


def _id_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (g1, g2, conv_id) rows to rows (g1, g2, first, ids) of up to ``ID_BLOCK`` joined ids."""
    for batch in batches:
        g1, g2, ids = (batch.column(k).to_numpy() for k in range(3))
        if not len(ids):
            continue
        turn = np.r_[True, (g1[1:] != g1[:-1]) | (g2[1:] != g2[:-1])]
        starts = np.flatnonzero(turn)
        run = np.arange(len(ids)) - np.repeat(starts, np.diff(np.r_[starts, len(ids)]))
        heads = np.flatnonzero(run % ID_BLOCK == 0)
        joined = [",".join(map(str, part.tolist())) for part in np.split(ids, heads[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(g1[heads]), pa.array(g2[heads]), pa.array(ids[heads]), pa.array(joined)], ["g1", "g2", "first", "ids"])


def _ends_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks sorted by node and first id to one SHA-256 per node, holding one block at a time."""
    key, sha = None, None

    def done():
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, sha.hexdigest())], ["g1", "g2", "ends_sha256"])

    for batch in batches:
        ready = []
        for g1, g2, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3))):
            if (g1, g2) != key:
                if key is not None:
                    ready.append(done())
                key, sha = (g1, g2), hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        if ready:
            yield pa.Table.from_batches(ready).combine_chunks().to_batches()[0]
    if key is not None:
        yield done()


def ends_digests(ends: DataFrame) -> DataFrame:
    """(g1, g2, ends_sha256) of (g1, g2, conv_id) rows."""
    sorted_ids = ends.select("g1", "g2", "conv_id").repartitionByRange("g1", "g2", "conv_id").sortWithinPartitions("g1", "g2", "conv_id")
    blocks = sorted_ids.mapInArrow(_id_blocks, "g1 long, g2 long, first long, ids string")
    return blocks.repartition("g1", "g2").sortWithinPartitions("g1", "g2", "first").mapInArrow(_ends_digests, "g1 long, g2 long, ends_sha256 string")


def nodes(conversations: DataFrame, heavy: int = HEAVY, band: int = BAND, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and
    its place (shard, slot) and digest (g1, g2)."""
    paths, convs = rebuilt(conversations)
    zero = F.lit(0).cast("long")
    spine = convs.select("conv_id", zero.alias("depth"), zero.alias("a"), zero.alias("b"), zero.alias("chars"), zero.alias("p1"), zero.alias("p2"), zero.alias("g1"), zero.alias("g2"))
    key = ["g1", "g2"]
    crowded = staged(paths.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > heavy).select(F.col("g1").alias("p1"), F.col("g2").alias("p2"), F.lit(True).alias("crowd")), "trie-heavy")
    marked = _looked_up(paths, ["p1", "p2"], crowded, ["conv_id"], "left").withColumn("top", (F.col("depth") % band == 1) | F.coalesce("crowd", F.lit(False)) if band > 1 else F.lit(True))
    in_band = Window.partitionBy("conv_id", F.floor((F.col("depth") - 1) / band)).orderBy("depth")
    to_top = F.last(F.when(F.col("top"), F.struct(F.col("g1").alias("f1"), F.col("g2").alias("f2"))), ignorenulls=True).over(in_band)
    placed = marked.withColumn("f", to_top).select("conv_id", "depth", "a", "b", "chars", "p1", "p2", *key, "top", "f.f1", "f.f2")
    placed = placed.unionByName(spine.withColumns({"top": F.lit(True), "f1": zero, "f2": zero}))

    same = [c for name in ("depth", "a", "b", "p1", "p2", "f1", "f2") for c in (F.min(name).alias(name), F.max(name).alias(f"_{name}"))]
    grouped = placed.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"), F.max("top").alias("top"), *same)
    clash = F.lit(False)
    for name in ("depth", "a", "b", "p1", "p2", "f1", "f2"):
        clash = clash | (F.col(name) != F.col(f"_{name}"))
    grouped = grouped.withColumn("depth", F.when(clash, F.raise_error(F.lit("two prefixes share a digest")).cast("long")).otherwise(F.col("depth")))

    ends = staged(_ends(paths, convs), "trie-ends")
    counted = ends.groupBy(*key).agg(F.count(F.lit(1)).alias("n_ends"))
    table = staged(grouped.join(counted, key, "left").select(*key, "depth", "p1", "p2", "f1", "f2", "top", "conv_id", "n_convs", "chars", F.coalesce("n_ends", F.lit(0)).alias("n_ends")), "trie-nodes")

    tops = table.where(F.col("top") & (F.col("depth") > 0))
    above = tops.select("p1", "p2").distinct()
    over = table.select(F.col("g1").alias("p1"), F.col("g2").alias("p2"), F.col("f1").alias("q1"), F.col("f2").alias("q2"), F.col("conv_id").alias("top_parent")).join(above, ["p1", "p2"], "left_semi")
    linked = staged(_looked_up(tops.select("f1", "f2", "p1", "p2"), ["p1", "p2"], over, ["f1", "f2"]), "trie-tops")
    own = table.where(F.col("depth") > 0).groupBy("f1", "f2").agg(F.sum((F.col("n_convs") == F.col("n_ends")).cast("long")).alias("leaves"), F.sum((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    fragments = staged(linked.join(own, ["f1", "f2"]).select("f1", "f2", "q1", "q2", "leaves", "saved"), "trie-fragments")
    hung = linked.select("f1", "f2", "p1", "p2").join(_totals(fragments), ["f1", "f2"]).groupBy(F.col("p1").alias("g1"), F.col("p2").alias("g2")).agg(
        F.count(F.lit(1)).alias("more_children"), F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))

    shards = max(1, -(-table.count() // shard_nodes))
    over_top = linked.select(F.col("f1").alias("g1"), F.col("f2").alias("g2"), "top_parent")
    full = table.join(hung, key, "left").join(over_top, key, "left").na.fill(0, ["more_children", "more_leaves", "more_saved", "top_parent"])
    summed = full.withColumn("shard", F.pmod(F.xxhash64("f1", "f2"), F.lit(shards))).drop("f1", "f2").groupBy("shard").applyInArrow(node_table, SHARD_OUT)
    empty = hashlib.sha256(b"").hexdigest()
    return summed.join(ends_digests(ends), key, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(empty)))


def _ends(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """(g1, g2, conv_id): the node at which each conversation ends; the root for those without turns."""
    deepest = paths.groupBy("conv_id").agg(F.max(F.struct("depth", "g1", "g2")).alias("e")).select("conv_id", F.col("e.g1").alias("g1"), F.col("e.g2").alias("g2"))
    return convs.select("conv_id").join(deepest, "conv_id", "left").select(F.coalesce("g1", F.lit(0)).cast("long").alias("g1"), F.coalesce("g2", F.lit(0)).cast("long").alias("g2"), "conv_id")
