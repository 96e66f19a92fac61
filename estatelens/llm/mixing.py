"""Mixing sources to target weights by a low-discrepancy schedule.

Targets: sources in code point order (null last) weigh 5, 2, 1, repeating, and share ``SHARE`` times all words; a target
stops at ``MAX_PASSES`` times its source's size and the excess is shared again by weight until none is above.

Schedule: slot i maps the golden-ratio point frac(i * phi) through the cumulative shares of the sources; the k-th slot
of a source takes the k-th block of ``BLOCK`` words of its documents, shuffled by hash and laid end to end, starting
over when the source is used up, until the target is reached. Every taken word so has a slot, and the mix read by slot
holds the target shares in each prefix, within the discrepancy of the sequence; ``dealt`` returns the blocks' pieces by
slot, ``taken`` each document's first and last slot, ``mixed`` its slots on request. The schedule runs longer than the blocks needed by what
the discrepancy of the sequence can make the smallest source wait, at most twice as long.

A hot source is ranked and summed in pieces (``common.running``), and blocks are equal, so that neither its slots nor
its documents meet in one task. Only tables of one row per source are summed in one place.

Edge cases: null and empty texts have size 0 and nothing is taken of them; a null source is a source of its own; rows
that agree in everything count each; an empty table gives an empty result; extra columns are ignored by ``taken`` and
kept by ``mixed``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import group_key, running, staged, text_of, words_of

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_PASSES = 2
BLOCK = 1024
CELLS = 4096
PHI = 0.6180339887498949
SLOT_PIECE = 1 << 16


def targets(sizes: DataFrame) -> DataFrame:
    """(_source, source_size, target) from rows (_source, _order, size); one row per source."""
    per = sizes.groupBy("_source", "_null", "_name").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy("_null", "_name"))
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.pmod(place - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    per = per.select("_source", "source_size", weight.alias("w"), (F.lit(float(MAX_PASSES)) * F.col("source_size")).alias("most"))
    per = per.withColumn("full_at", F.col("most") / F.col("w"))
    before = Window.orderBy("full_at", "_source").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    level = (SHARE * F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    per = per.withColumn("level", level)
    rate = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "_source", "level"))).over(everything)["level"]
    return per.select("_source", "source_size", F.least(F.col("most"), rate * F.col("w")).alias("target"))


def _laid_out(docs: DataFrame, id_col: str, text: str, source: str) -> DataFrame:
    key = F.col(source).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), group_key(key).alias("_source"), key.isNull().alias("_null"), F.coalesce(key, F.lit("")).alias("_name"),
                       F.size(words_of(text_of(text))).cast("long").alias("size"), F.xxhash64(F.col(text)).alias("_h"))
    return staged(rows.withColumn("_mix", F.xxhash64("id", "_h", F.lit(17))), "mix-sizes")


def schedule(per: DataFrame) -> DataFrame:
    """(_source, slot, pass, block, take): which block each slot takes and how many of its words."""
    spark = per.sparkSession
    size, goal = F.col("source_size"), F.round("target").cast("long")
    per = per.where(goal > 0).select("_source", "source_size", goal.alias("goal"), F.ceil(size / BLOCK).alias("blocks"))
    rest = F.col("goal") % size
    per = per.withColumn("need", F.floor(F.col("goal") / size) * F.col("blocks") + F.ceil(rest / BLOCK))
    ends = F.sum("need").over(Window.orderBy("_source").rowsBetween(Window.unboundedPreceding, 0))
    per = staged(per.withColumn("end", ends).coalesce(1), "mix-shares")
    n, least = per.agg(F.coalesce(F.sum("need"), F.lit(0)), F.coalesce(F.min("need"), F.lit(1))).first()
    wait = (6 + 2 * max(1, n).bit_length()) * n // max(1, least)
    slots = spark.range(n + min(n + 1024, wait) if n else 0).select(F.col("id").alias("slot"), F.pmod((F.col("id") + 0.5) * PHI, F.lit(1.0)).alias("u"))
    slots = slots.withColumn("_cell", F.floor(F.col("u") * CELLS))
    low, high = (F.col("end") - F.col("need")) / F.lit(float(max(1, n))), F.col("end") / F.lit(float(max(1, n)))
    spread = per.select("*", low.alias("low"), high.alias("high")).withColumn("_cell", F.explode(F.sequence(F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1)))))
    dealt = slots.join(spread, "_cell").where((F.col("u") >= F.col("low")) & (F.col("u") < F.col("high")))
    dealt = running(dealt.withColumn("_piece", F.floor(F.col("slot") / SLOT_PIECE)), ["_source"], "_piece", ["slot"], {}, "k")
    before = F.floor(F.col("k") / F.col("blocks")) * size + F.col("k") % F.col("blocks") * BLOCK
    length = F.least(F.lit(BLOCK), size - F.col("k") % F.col("blocks") * BLOCK)
    return dealt.select("_source", "slot", F.floor(F.col("k") / F.col("blocks")).alias("pass"), (F.col("k") % F.col("blocks")).alias("block"),
                        F.least(length, F.col("goal") - before).alias("take")).where(F.col("take") > 0)


def _dealt(docs: DataFrame, id_col: str, text: str, source: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents laid out, the targets, and the pieces of documents in the blocks that the slots take."""
    rows = _laid_out(docs, id_col, text, source)
    per = staged(targets(rows).coalesce(1), "mix-targets")
    at = running(rows.withColumn("_piece", F.shiftright("_mix", 54)), ["_source"], "_piece", ["_mix", "id", "_h"], {"pos": F.col("size")}, "_rank")
    at = staged(at.select("id", "_source", "_h", "size", "pos", "_rank"), "mix-layout")
    pieces = at.where(F.col("size") > 0).withColumn("block", F.explode(F.sequence(F.floor(F.col("pos") / BLOCK), F.floor((F.col("pos") + F.col("size") - 1) / BLOCK))))
    start = F.col("block") * BLOCK
    first = F.greatest(F.col("pos"), start)
    got = F.least(F.col("pos") + F.col("size"), start + F.col("take")) - first
    pieces = pieces.join(schedule(per), ["_source", "block"]).where(got > 0)
    return at, per, pieces.select("id", "_source", "_h", "_rank", "size", "slot", "pass", "block", (first - F.col("pos")).alias("start"), got.alias("words"))


def dealt(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per piece of a document in a slot's block: id, ``_source`` (key), slot, pass, block, the first word and the words taken."""
    return _dealt(docs, id_col, text, source)[2].select(F.col("id").alias(id_col), "_source", "slot", "pass", "block", "start", "words")


def taken(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document: id, size, source_size, target of its source, the words that the mix takes of it, and the
    first and last slot that take them (null: none)."""
    at, per, pieces = _dealt(docs, id_col, text, source)
    got = pieces.groupBy("_source", "_rank").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot"))
    return at.join(got, ["_source", "_rank"], "left").join(per, "_source").select(
        F.col("id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot", "last_slot")


def mixed(docs: DataFrame, with_slots: bool = False) -> DataFrame:
    """The mix as documents: one row per document and pass of its source, with the whole text or its first words where
    the target ends within it. ``with_slots`` adds ``mix_slot`` (the first that takes it in this pass) and ``mix_pass``.
    Rows that agree in id, source and text share evenly what is taken of them in a pass."""
    at, _, pieces = _dealt(docs, "doc_id", "text", "source")
    key = ["id", "_source", "_h"]
    alike = at.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    got = pieces.groupBy(*key, "pass").agg(F.sum("words").alias("_words"), F.min("slot").alias("_slot"), F.first("size").alias("_size"))
    same = [a.eqNullSafe(b) if k == "id" else a == b for k in key for a, b in [(F.col(k), F.col(f"_n_{k}"))]]
    got = got.join(alike.select(*[F.col(k).alias(f"_n_{k}") for k in key], "_n"), same)
    got = got.select(*[F.col(k).alias(f"_g_{k}") for k in key], "pass", "_slot", "_size", F.floor(F.col("_words") / F.col("_n")).cast("int").alias("_first")).where(F.col("_first") > 0)
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("_i"), group_key(F.col("source")).alias("_s"), F.xxhash64("text").alias("_x"))
    hit = own.join(got, F.col("_i").eqNullSafe(F.col("_g_id")) & (F.col("_s") == F.col("_g__source")) & (F.col("_x") == F.col("_g__h")))
    cut = F.col("_first") < F.col("_size")
    text = F.when(cut, F.array_join(F.slice(words_of(F.col("row.text")), F.lit(1), F.col("_first")), " ")).otherwise(F.col("row.text"))
    new = {"text": text, "n_chars": F.when(cut, F.length(text).cast("long")).otherwise(F.col("row.n_chars"))}
    slots = [F.col("_slot").alias("mix_slot"), F.col("pass").alias("mix_pass")] if with_slots else []
    return hit.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns], *slots)
