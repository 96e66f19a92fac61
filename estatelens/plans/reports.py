"""Ready-made reports over the marts and the star schema (documented queries and dashboard feeds)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import UNKNOWN, round2


def top_districts(district_summary: DataFrame, n: int = 10) -> DataFrame:
    """Most expensive districts by avg price per m² (rank order, then city / district): a top-k, so
    ``orderBy + limit`` plans as TakeOrderedAndProject (per-task top-n, then merge)."""
    return (district_summary.filter(F.col("district") != UNKNOWN)
            .select("city", "district", "avg_price_per_sqm", "rank_most_expensive")
            .orderBy("rank_most_expensive", "city", "district").limit(n))


def trend_month(trends: DataFrame) -> DataFrame:
    return (trends.filter(F.col("period_type") == "month")
            .select("period_start", "avg_price", "price_change_pct").orderBy("period_start"))


def region_rollup(fact: DataFrame, dim_city: DataFrame) -> DataFrame:
    """Avg price per m² by voivodeship (dim_city is one row per city; AQE broadcasts it when small)."""
    j = fact.join(dim_city.select("city_key", "voivodeship"), "city_key")
    return (j.groupBy("voivodeship").agg(F.count(F.lit(1)).alias("num_listings"),
                                          round2(F.avg("price_per_sqm_calculated")).alias("avg_price_per_sqm"))
            .orderBy(F.col("avg_price_per_sqm").desc()))


def kpi(price_statistics: DataFrame) -> DataFrame:
    """KPI cards: average price, average price per m², median price, listings count."""
    return price_statistics.select("avg_price", "avg_price_per_sqm", "median_price", "total_listings")


def daily_volume(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Average price and listing volume per collection day (fact.date_collected_key -> dim_date)."""
    j = fact.join(dim_date.select("date_key", "date_day"), fact.date_collected_key == F.col("date_key"))
    return j.groupBy("date_day").agg(round2(F.avg("price")).alias("avg_price"),
                                     F.count(F.lit(1)).alias("num_listings"))


def market_compare(fact: DataFrame, dim_market: DataFrame) -> DataFrame:
    """Primary vs secondary (vs Unknown) market: count, avg price, avg price per m²."""
    j = fact.join(dim_market, "market_key")
    return j.groupBy("market_type").agg(F.count(F.lit(1)).alias("num_listings"),
                                        round2(F.avg("price")).alias("avg_price"),
                                        round2(F.avg("price_per_sqm_calculated")).alias("avg_price_per_sqm"))


def top_cities(city_summary: DataFrame, n: int = 10) -> DataFrame:
    return city_summary.select("city", "avg_price", "num_listings").orderBy(F.col("avg_price").desc(), "city").limit(n)


def dual_series(fact: DataFrame) -> DataFrame:
    """Avg price and avg price per m² by collection day key (two series, one scan)."""
    return fact.groupBy("date_collected_key").agg(round2(F.avg("price")).alias("avg_price"),
                                                  round2(F.avg("price_per_sqm_calculated")).alias("avg_price_per_sqm"))


def map_points(fact: DataFrame, dim_city: DataFrame) -> DataFrame:
    """Listing coordinates for the map visual (rows with both coordinates)."""
    j = fact.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()) \
        .join(dim_city.select("city_key", "city"), "city_key")
    return j.select("listing_id", "city", "latitude", "longitude", "price")
