"""Native column expressions used across the engine."""

from .keys import (NULL_KEY_PLACEHOLDER, UNKNOWN, date_key, or_unknown, price_per_sqm_expr, round2, safe_ratio,
                   surrogate_key, to_utc_wallclock, utc_day)
from .labels import bool_label, floor, market, price_per_m, rooms
from .text import first_int, fold, initcap_words, leading_number, unicode_trim

__all__ = [
    "NULL_KEY_PLACEHOLDER", "UNKNOWN", "date_key", "or_unknown", "price_per_sqm_expr", "round2", "safe_ratio",
    "surrogate_key", "to_utc_wallclock", "utc_day", "bool_label", "floor", "market", "price_per_m",
    "rooms", "first_int", "fold", "initcap_words", "leading_number", "unicode_trim",
]
