"""Staging (current state, one row per listing) and the daily grain (one row per listing per day).

The city seed is a bounded table (one row per scrape target), so it is broadcast. The bounds filter
runs before the latest-row dedup: an invalid newest scrape falls back to the newest valid one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import initcap_words, price_per_sqm_expr, surrogate_key, to_utc_wallclock, utc_day
from ..operators.dedup import latest_per_key
from ..session import small

PRICE_MIN, PRICE_MAX = 1, 20_000_000
AREA_MIN, AREA_MAX = 10, 500


def standardize_city(raw: DataFrame, lookup: DataFrame | None) -> DataFrame:
    """Add ``city``: seed display name, else (or without a seed) the slug capitalised word by word."""
    if lookup is None:
        return raw.withColumn("city", initcap_words(F.col("source_city")))
    seed = small(lookup.select("source_city", F.col("city_name").alias("_city_name")))
    return (raw.join(seed, "source_city", "left")
            .withColumn("city", F.coalesce(F.col("_city_name"), initcap_words(F.col("source_city"))))
            .drop("_city_name"))


def renamed(raw: DataFrame, lookup: DataFrame | None, extra: Sequence[str] = ()) -> DataFrame:
    """Raw scan projected to the staging columns (keys, parsed publish time, standard city)."""
    j = raw.select(*[c for c in raw.columns if c != "city"])
    if lookup is None:
        j = j.withColumn("_city_name", F.lit(None).cast("string"))
    else:
        j = j.join(small(lookup.select("source_city", F.col("city_name").alias("_city_name"))), "source_city", "left")
    return j.select(
        surrogate_key(F.col("id")).alias("listing_key"),
        F.col("id").alias("listing_id"),
        "url", "title",
        to_utc_wallclock(F.col("created_time")).alias("date_published"),
        "date_collected",
        F.coalesce(F.col("_city_name"), initcap_words(F.col("source_city"))).alias("city"),
        F.col("source_city").alias("source_city_raw"),
        "district", "latitude", "longitude", "price", "currency", "area_sqm", "extra_rent_pln",
        "num_rooms", "rooms_capped", "floor", "floor_capped", "is_furnished", "building_type",
        "market_type", "price_per_sqm_listed", *extra,
    )


def in_bounds(df: DataFrame, id_col: str = "listing_id") -> DataFrame:
    return df.filter(F.col(id_col).isNotNull()
                     & F.col("price").between(PRICE_MIN, PRICE_MAX)
                     & F.col("area_sqm").between(AREA_MIN, AREA_MAX))


def latest_order(tiebreak: Sequence[str] = (), rest: Sequence[str] = ()) -> list[Column]:
    """Newest first, then ``tiebreak``, then the remaining columns: a total order, so that ties do not
    depend on how the rows are dealt out."""
    named = {"date_collected", *tiebreak}
    return [F.col(c).desc() for c in ("date_collected", *tiebreak, *(c for c in rest if c not in named))]


def stg_listings(raw: DataFrame, lookup: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Current state: newest in-bounds scrape per listing."""
    # the key is a digest of the id, which a shuffle cannot pack: it is made again once one row per listing is left
    base = in_bounds(renamed(raw, lookup, extra=tiebreak)).drop("listing_key")
    out = latest_per_key(base, ["listing_id"], latest_order(tiebreak, base.columns))
    return out.select(surrogate_key(F.col("listing_id")).alias("listing_key"), *[c for c in base.columns if c not in tiebreak])


def listings_daily(raw: DataFrame, lookup: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Daily grain: newest in-bounds scrape per (listing, UTC day)."""
    base = standardize_city(raw, lookup).select(
        F.col("id").alias("listing_id"), "date_collected", "city", "price", "area_sqm",
        price_per_sqm_expr().alias("price_per_sqm_calculated"), *tiebreak)
    base = in_bounds(base)
    out = latest_per_key(base, ["listing_id", utc_day("date_collected")], latest_order(tiebreak, base.columns))
    return out.drop(*tiebreak)


def stg_daily(raw: DataFrame, lookup: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Staging columns at daily grain: newest in-bounds scrape per (listing, UTC day). This is the
    state a daily snapshot run sees, used by the history backfill."""
    base = in_bounds(renamed(raw, lookup, extra=tiebreak))
    out = latest_per_key(base, ["listing_id", utc_day("date_collected")], latest_order(tiebreak, base.columns))
    return out.drop(*tiebreak)


def max_day(raw: DataFrame):
    """Newest UTC collection day (a one-row aggregate returned as a scalar)."""
    return raw.agg(F.max(utc_day("date_collected")).alias("d")).first()["d"]
