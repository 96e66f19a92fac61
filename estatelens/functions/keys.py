"""Keys, rounding and date parts shared by every model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Placeholder and separator of the surrogate-key convention (md5 over the
# '-'-joined string forms of the inputs, a null input replaced by this placeholder).
NULL_KEY_PLACEHOLDER = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"

# Fixed value: sentinel for a missing district / building type / market.
UNKNOWN = "Unknown"


def surrogate_key(*cols) -> Column:
    parts = [F.coalesce(as_col(c).cast("string"), F.lit(NULL_KEY_PLACEHOLDER)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def or_unknown(c) -> Column:
    return F.coalesce(as_col(c), F.lit(UNKNOWN))


def round2(c, digits: int = 2) -> Column:
    """Half-up rounding on the decimal value of a double.

    Rounding the binary double directly differs between engines at ties (x.xx5); going through
    decimal(38,10) makes every engine agree.
    """
    return F.round(as_col(c).cast("decimal(38,10)"), digits).cast("double")


def safe_ratio(num, den) -> Column:
    """num / den, null when den is 0 or null (ANSI-safe)."""
    return F.try_divide(as_col(num), as_col(den))


def utc_day(c) -> Column:
    """Calendar day of a UTC wall-clock timestamp (timestamp_ntz)."""
    return F.to_date(as_col(c))


def date_key(c) -> Column:
    """yyyyMMdd as int, from a date or UTC wall-clock timestamp."""
    d = F.to_date(as_col(c))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def to_utc_wallclock(c) -> Column:
    """Parse ISO text with an optional offset into a UTC timestamp_ntz (no offset = UTC); junk gives null.

    The instant is read with try_cast (tolerant) and its microseconds since the epoch are added to the
    epoch's wall clock, so the result does not depend on the session time zone or its clock changes.
    """
    c = as_col(c)
    has_offset = c.rlike(r"(?i)(z|[+-][0-9]{2}(:?[0-9]{2})?)$")
    instant = c.try_cast("timestamp")
    since_epoch = (F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    moved = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), since_epoch)
    # text without an offset is already a UTC wall clock
    return F.when(has_offset, moved).otherwise(c.try_cast("timestamp_ntz"))


def price_per_sqm_expr(price="price", area="area_sqm") -> Column:
    """price / area rounded to 2 dp; null when the area is 0 or null."""
    return round2(safe_ratio(price, area))
