"""Star schema: four small dimensions, a day spine, and the listing fact (full, incremental, merged)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import date_key, or_unknown, price_per_sqm_expr, surrogate_key
from ..operators.merge import merge_by_key
from ..session import small

SPINE_START = dt.date(2010, 1, 1)


def dim_city(stg: DataFrame, lookup: DataFrame | None) -> DataFrame:
    """One row per city; without a seed no region is known and no city is flagged."""
    cities = stg.select("city").distinct()
    if lookup is None:
        return cities.select(surrogate_key(F.col("city")).alias("city_key"), "city", F.lit(None).cast("string").alias("voivodeship"), F.lit(False).alias("is_mvp"))
    seed = small(lookup.select(F.col("city_name").alias("city"), "voivodeship", "is_mvp"))
    return cities.join(seed, "city", "left").select(
        surrogate_key(F.col("city")).alias("city_key"), "city", "voivodeship",
        F.coalesce(F.col("is_mvp"), F.lit(False)).alias("is_mvp"))


def dim_district(stg: DataFrame) -> DataFrame:
    d = stg.select("city", or_unknown(F.col("district")).alias("district")).distinct()
    return d.select(surrogate_key(F.col("city"), F.col("district")).alias("district_key"), "city", "district")


def dim_building_type(stg: DataFrame) -> DataFrame:
    d = stg.select(or_unknown(F.col("building_type")).alias("building_type")).distinct()
    return d.select(surrogate_key(F.col("building_type")).alias("building_type_key"), "building_type")


def dim_market(stg: DataFrame) -> DataFrame:
    d = stg.select(or_unknown(F.col("market_type")).alias("market_type")).distinct()
    return d.select(surrogate_key(F.col("market_type")).alias("market_key"), "market_type")


def one_year_after(day: dt.date) -> dt.date:
    if day.month == 2 and day.day == 29:
        return day.replace(year=day.year + 1, day=28)
    return day.replace(year=day.year + 1)


def dim_date(spark: SparkSession, start: dt.date = SPINE_START, end: dt.date | None = None) -> DataFrame:
    """Day spine [start, end) with calendar attributes. ``end`` defaults to as-of + 1 year.

    Built from ``spark.range`` so the rows are generated in parallel, not in one task.
    """
    if end is None:
        end = one_year_after(dt.date.today())
    n = (end - start).days
    day = F.date_add(F.lit(start), F.col("id").cast("int"))
    d = spark.range(0, max(n, 0)).select(day.alias("date_day"))
    dow = F.dayofweek("date_day")  # Sunday = 1 ... Saturday = 7
    return d.select(
        date_key(F.col("date_day")).alias("date_key"),
        "date_day",
        F.year("date_day").alias("year"),
        F.quarter("date_day").alias("quarter"),
        F.month("date_day").alias("month"),
        F.date_format("date_day", "MMMM").alias("month_name"),
        F.dayofmonth("date_day").alias("day_of_month"),
        dow.alias("day_of_week"),
        F.date_format("date_day", "EEEE").alias("day_name"),
        F.weekofyear("date_day").alias("iso_week_of_year"),
        dow.isin(1, 7).alias("is_weekend"),
    )


FACT_COLUMNS = [
    "listing_key", "listing_id", "city_key", "district_key", "building_type_key", "market_key",
    "date_collected_key", "date_published_key", "price", "currency", "area_sqm", "price_per_sqm_listed",
    "price_per_sqm_calculated", "num_rooms", "rooms_capped", "floor", "floor_capped", "is_furnished",
    "extra_rent_pln", "latitude", "longitude", "url",
]


def fact(stg: DataFrame) -> DataFrame:
    """Fact rows from staging: hashed dimension keys, int day keys, measures."""
    return stg.select(
        "listing_key", "listing_id",
        surrogate_key(F.col("city")).alias("city_key"),
        surrogate_key(F.col("city"), or_unknown(F.col("district"))).alias("district_key"),
        surrogate_key(or_unknown(F.col("building_type"))).alias("building_type_key"),
        surrogate_key(or_unknown(F.col("market_type"))).alias("market_key"),
        date_key(F.col("date_collected")).alias("date_collected_key"),
        F.when(F.col("date_published").isNotNull(), date_key(F.col("date_published"))).alias("date_published_key"),
        "price", "currency", "area_sqm", "price_per_sqm_listed",
        price_per_sqm_expr().alias("price_per_sqm_calculated"),
        "num_rooms", "rooms_capped", "floor", "floor_capped", "is_furnished", "extra_rent_pln",
        "latitude", "longitude", "url",
    )


def watermark(target: DataFrame) -> int:
    """coalesce(max(date_collected_key), 0) of the target: a one-row aggregate, used as a literal."""
    row = target.agg(F.coalesce(F.max("date_collected_key"), F.lit(0)).alias("wm")).first()
    return int(row["wm"])


def incremental_slice(stg: DataFrame, target: DataFrame | None, wm: int | None = None,
                      lookback_days: int = 0) -> DataFrame:
    """Staging rows collected on or after the target's newest day (same-day reruns re-merge).

    Default (``lookback_days=0``): a batch dated before that day is never merged (late data is lost,
    as in the source pipeline). ``lookback_days=n`` re-reads n more days before the watermark.
    """
    if target is None and wm is None:
        return stg
    wm = watermark(target) if wm is None else wm
    if lookback_days and wm > 0:
        start = dt.date(wm // 10000, wm // 100 % 100, wm % 100) - dt.timedelta(days=lookback_days)
        wm = start.year * 10000 + start.month * 100 + start.day
    # on staging rows this filter stands above the latest-row window; ``plans.incremental`` finds the same rows by
    # reading only the raw table's day partitions from the watermark on
    return stg.filter(date_key(F.col("date_collected")) >= F.lit(wm))


def incremental_fact(stg: DataFrame, target: DataFrame | None, full_refresh: bool = False,
                     lookback_days: int = 0) -> DataFrame:
    """New fact version: full build on first run / refresh, else merge of the incremental slice."""
    if target is None or full_refresh:
        return fact(stg)
    return merge_by_key(target, fact(incremental_slice(stg, target, lookback_days=lookback_days)), ["listing_key"])
