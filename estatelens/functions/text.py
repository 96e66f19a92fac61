"""Text expressions: diacritic folding, word capitalisation, locale number parsing.

All of them compile to native Catalyst expressions (translate / regexp / higher-order functions), so
they stay inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Letters with no Unicode decomposition that the fold maps by hand.
SPECIAL_FOLDS = {"ł": "l", "Ł": "L"}

# Word delimiters of warehouse-style INITCAP (its documented default set) plus
# whitespace. A letter right after one of these (or at the start) is upper-cased, the rest lowered.
INITCAP_DELIMITERS = " []{}()/|\\<>!?@\"^#$&~_,.:;*%+-"


def _fold_table() -> tuple[str, str]:
    """Build the translate() table by rule: every Latin letter in U+00C0..U+024F whose NFKD
    decomposition is one ASCII letter plus combining marks maps to that letter."""
    src, dst = [], []
    for cp in range(0x00C0, 0x0250):
        ch = chr(cp)
        if ch in SPECIAL_FOLDS:
            continue
        base = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if len(base) == 1 and base != ch and base.isascii():
            src.append(ch)
            dst.append(base)
    for k, v in SPECIAL_FOLDS.items():
        src.append(k)
        dst.append(v)
    return "".join(src), "".join(dst)


FOLD_FROM, FOLD_TO = _fold_table()


def unicode_trim(c) -> Column:
    """Strip leading/trailing Unicode whitespace (Python ``str.strip`` semantics)."""
    return F.regexp_replace(as_col(c), r"(?U)^\s+|\s+$", "")


def fold(c) -> Column:
    """Strip diacritics (including ł/Ł), lower-case and trim: 'Łódź ' -> 'lodz'."""
    return F.lower(unicode_trim(F.translate(as_col(c), FOLD_FROM, FOLD_TO)))


def initcap_words(c) -> Column:
    """Capitalise each word, splitting on whitespace and punctuation (incl. '-').

    Spark's ``initcap`` splits on spaces only ('bielsko-biala' -> 'Bielsko-biala'); this gives
    'Bielsko-Biala'. Implemented with ``transform`` over the character array.
    """
    chars = F.split(as_col(c), "")
    delim = "[" + "".join("\\" + ch if ch in "[]\\^-" else ch for ch in INITCAP_DELIMITERS) + r"\s]"

    def cap(ch, i):
        prev = F.element_at(chars, i)  # element_at is 1-based, so index i is the previous char
        return F.when((i == 0) | prev.rlike("^" + delim + "$"), F.upper(ch)).otherwise(F.lower(ch))

    return F.when(as_col(c).isNull(), F.lit(None).cast("string")).otherwise(
        F.array_join(F.transform(chars, cap), ""))


def leading_number(c) -> Column:
    """First run of digits/whitespace/','/'.' parsed as a number: '48,5 m²' -> 48.5.

    Only ASCII spaces are removed and ',' becomes '.'; anything else left in the run (an inner
    no-break space, '1.234,5', a run made of blanks only) does not parse and gives null.
    """
    run = F.regexp_extract(as_col(c), r"(?U)([\d\s,.]+)", 1)
    # guard the cast: only plain decimal text reaches try_cast; one chain, so that nothing is evaluated twice
    return F.regexp_extract(F.translate(run, ", ", "."), r"(?U)^\s*([0-9]+\.?[0-9]*|\.[0-9]+)\s*$", 1).try_cast("double")


def first_int(c) -> Column:
    """First run of digits as a long, or null."""
    return F.regexp_extract(as_col(c), r"(?U)(\d+)", 1).try_cast("long")
