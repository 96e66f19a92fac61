"""Listing label decoders (room bucket, floor bucket, yes/no, market) as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col
from .text import first_int, leading_number, unicode_trim

# Label vocabulary of the listing source.
STUDIO_WORD = "kawalerka"
ROOMS_CAPPED_WORDS = ("więcej", "wiecej")
GROUND_FLOOR_WORD = "parter"
FLOOR_CAPPED_WORDS = ("powyżej", "powyzej")
YES_WORD = "tak"
MARKET_LABELS = {"pierwotny": "primary", "wtórny": "secondary"}


def _blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def _contains_any(c: Column, words) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | c.contains(w)
    return out


def rooms(c) -> Column:
    """Room label -> struct(num_rooms long, rooms_capped boolean).

    'Kawalerka' -> (1, false); '4 i więcej' -> (4, true); '2 pokoje' -> (2, false);
    null/blank or no digits -> (null, false).
    """
    c = as_col(c)
    s = F.lower(c)
    n = F.when(_blank(c), F.lit(None).cast("long")) \
        .when(s.contains(STUDIO_WORD), F.lit(1).cast("long")) \
        .otherwise(first_int(s))
    capped = F.when(_blank(c) | s.contains(STUDIO_WORD) | n.isNull(), F.lit(False)) \
        .otherwise(_contains_any(s, ROOMS_CAPPED_WORDS))
    return F.struct(n.alias("num_rooms"), capped.alias("rooms_capped"))


def floor(c) -> Column:
    """Floor label -> struct(floor long, floor_capped boolean).

    'Parter' -> (0, false); 'Powyżej 10' -> (10, true); '9' -> (9, false); null/blank -> (null, false).
    The capped flag depends on the words only, even when no number is present.
    """
    c = as_col(c)
    s = F.lower(unicode_trim(c))
    n = F.when(_blank(c), F.lit(None).cast("long")) \
        .when(s == GROUND_FLOOR_WORD, F.lit(0).cast("long")) \
        .otherwise(first_int(s))
    capped = F.when(_blank(c) | (s == GROUND_FLOOR_WORD), F.lit(False)) \
        .otherwise(_contains_any(s, FLOOR_CAPPED_WORDS))
    return F.struct(n.alias("floor"), capped.alias("floor_capped"))


def bool_label(c) -> Column:
    """'Tak' -> true; any other text (including blank) -> false; null -> null."""
    c = as_col(c)
    return F.when(c.isNull(), F.lit(None).cast("boolean")).otherwise(
        F.lower(unicode_trim(c)) == YES_WORD)


def market(c) -> Column:
    """'Pierwotny' -> 'primary', 'Wtórny' -> 'secondary', anything else -> null."""
    known = F.create_map(*[F.lit(x) for pair in MARKET_LABELS.items() for x in pair])
    return F.try_element_at(known, F.lower(unicode_trim(as_col(c))))


def price_per_m(c) -> Column:
    """'6750 zł/m²' -> 6750.0."""
    return leading_number(c)
