"""Positions of regular-expression matches as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import let


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """All leftmost non-overlapping matches: structs of start ``s`` and end ``e`` in code points and matched ``m``
    (``group`` of it). ``split`` and ``regexp_extract_all`` walk the same matches, so the texts between them and the
    matches' lengths add up to positions."""
    rx = F.lit(pattern)

    def laid(found: Column) -> Column:
        shown = F.regexp_extract_all(text, rx, F.lit(group)) if group else found
        gaps = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.greatest(F.size(found), F.lit(1))), found, lambda gap, m: F.struct(F.length(gap).alias("g"), F.length(m).alias("n")))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int>>").alias("out"))
        spans = F.aggregate(gaps, start, lambda a, x: F.struct((a["at"] + x["g"] + x["n"]).alias("at"), F.concat(a["out"], F.array(F.struct((a["at"] + x["g"]).alias("s"), (a["at"] + x["g"] + x["n"]).alias("e")))).alias("out")))["out"]
        return F.zip_with(spans, shown, lambda p, m: F.struct(p["s"].alias("s"), p["e"].alias("e"), m.alias("m")))

    empty = F.array().cast("array<struct<s:int,e:int,m:string>>")
    return let(F.regexp_extract_all(text, rx, F.lit(0)), lambda found: F.when(F.size(found) > 0, laid(found)).otherwise(empty))


def kept(found: Column, valid) -> Column:
    return F.filter(found, lambda x: valid(x["m"]))


def ordered(parts: dict[str, Column]) -> Column:
    """Spans of several kinds as structs (s, k, e) by start, then kind as listed."""
    def tagged(k: int, spans: Column) -> Column:
        return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e")))

    return F.sort_array(F.concat(*[tagged(k, spans) for k, spans in enumerate(parts.values())]))


def written(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda x: F.concat(F.element_at(names, x["k"] + 1), F.lit(":"), x["s"].cast("string"), F.lit(":"), x["e"].cast("string"))), ",")


def apart(x: Column, spans: Column) -> Column:
    """Whether a span overlaps none of ``spans``."""
    return ~F.exists(spans, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
