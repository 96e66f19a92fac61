"""Sharding by sampled splitters.

A row's key is the hash of its text, then that of its id, so that equal texts lie side by side. Keys are drawn with a
probability in proportion to the row's weight (half its share of the bytes, half its share of the rows), boundaries of
equal sampled weight cut the key space into ``RANGES`` ranges, and ranges that turn out heavier than twice their share
are sampled again and subdivided. Exact sums of the ranges and running sums within each give every row its byte offset
in key order, and shard k takes the rows that start in the k-th equal part of all bytes.

The sample has ``SAMPLE`` rows in expectation and is the only data the driver sees; texts are never shuffled, and a
group of copies with a third of all bytes is spread over as many ranges as its bytes deserve.

Edge cases: a null text has size 1 and no checksum; a null id is a value of its own; repeated rows are interchangeable
and count each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import running, staged

SHARDS = 16
RANGES = 1024
SAMPLE = 16_384
ROUNDS = 3
FAN = 32


def _keyed(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    t = F.col(text)
    part = lambda c: F.lpad(F.hex(c), 16, "0")
    return staged(docs.select(F.col(id_col).alias("id"), (F.coalesce(F.octet_length(t), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(t.cast("binary")).alias("text_crc32"),
                              F.concat(part(F.xxhash64(t)), part(F.xxhash64(F.col(id_col)))).alias("key")), "shard-keys")


def _range_of(key: Column, splitters: list[str]) -> Column:
    """The number of splitters at or below the key, by a search over every ``FAN``-th one and then one run of them."""
    if not splitters:
        return F.lit(0)
    runs = [splitters[i:i + FAN] for i in range(0, len(splitters), FAN)]
    below = F.size(F.filter(F.array(*[F.lit(r[0]) for r in runs]), lambda x: x <= key))
    fine = F.element_at(F.array(*[F.array(*[F.lit(x) for x in r]) for r in runs]), F.greatest(below, F.lit(1)))
    return F.when(below == 0, 0).otherwise((below - 1) * FAN + F.size(F.filter(fine, lambda x: x <= key)))


def _splitters(rows: DataFrame, weight: Column, ranges: int, sample: int) -> list[str]:
    u = F.pmod(F.xxhash64("key", F.lit(11)), F.lit(1 << 40)) / float(1 << 40)

    def drawn(of: DataFrame, rate: float) -> list[tuple[str, float]]:
        got = of.where(u < weight * rate).select("key", F.greatest(weight * rate, F.lit(1.0)).alias("w")).collect()  # about ``sample`` rows
        return sorted((r["key"], r["w"]) for r in got)

    def cuts(points: list[tuple[str, float]], n: int) -> list[str]:
        sums = list(accumulate(w for _, w in points))
        return [points[bisect_left(sums, sums[-1] * k / n)][0] for k in range(1, n)] if points else []

    found = sorted(set(cuts(drawn(rows, float(sample)), ranges)))
    for again in range(1, ROUNDS + 1):
        at = _range_of(F.col("key"), found)
        heavy = {r["at"]: r["w"] for r in rows.groupBy(at.alias("at")).agg(F.sum(weight).alias("w")).where(F.col("w") > 2.0 / ranges).collect()}  # at most ranges / 2 rows
        if not heavy:
            break
        parts: dict[int, list] = {k: [] for k in heavy}
        for key, w in drawn(rows.where(at.isin(list(heavy))), float(sample) * 4 ** again / max(1.0, 4 ** again * sum(heavy.values()))):
            parts[bisect_left(found, key + "~")].append((key, w))
        found = sorted({*found, *(c for k, p in parts.items() for c in cuts(p, 2 * int(heavy[k] * ranges) + 1))})
    return found


def sharded(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shards: int = SHARDS, ranges: int = RANGES, sample: int = SAMPLE) -> DataFrame:
    """One row per document: id, size, text_crc32, shard, and slot (its place in the shard, in key order)."""
    rows = _keyed(docs, id_col, text)
    n, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    weight = F.col("size") / F.lit(2.0 * max(1, total)) + F.lit(0.5 / max(1, n))
    cut = rows.withColumn("_range", _range_of(F.col("key"), _splitters(rows, weight, ranges, sample)))
    placed = running(cut, [], "_range", ["key", "id"], {"_at": F.col("size")}, "_index")
    placed = staged(placed.withColumn("shard", F.floor(F.col("_at") / F.lit(max(1, total)) * shards).cast("int")), "shard-rows")
    firsts = placed.groupBy("shard").agg(F.min("_index").alias("_first"))
    return placed.join(F.broadcast(firsts), "shard").select(F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("_index") - F.col("_first")).alias("slot"))
