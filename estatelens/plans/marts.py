"""Marts: global KPIs, city and district summaries, day/week/month market trends."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import UNKNOWN, round2, safe_ratio, utc_day
from ..operators.quantile import quantiles
from ..session import written


def price_statistics(fact: DataFrame) -> DataFrame:
    """One row: count, avg / median / min / max / sample stddev of price, avg / median price per m².

    All of them, the medians' sketches included, come from one partial aggregate; the medians are exact (see
    ``quantiles``). ``generated_at`` is added by the caller when wanted.
    """
    # read twice: a narrow written projection, not the fact's lineage
    fact = written(fact.select("price", "price_per_sqm_calculated"), "prices")
    out = quantiles(fact, {"median_price": "price", "median_price_per_sqm": "price_per_sqm_calculated"}, also=[
        F.count(F.lit(1)).alias("total_listings"),
        round2(F.avg("price")).alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        round2(F.stddev_samp("price")).alias("stddev_price"),
        round2(F.avg("price_per_sqm_calculated")).alias("avg_price_per_sqm"),
    ])
    return out.select("total_listings", "avg_price", "median_price", "min_price", "max_price",
                      "stddev_price", "avg_price_per_sqm", "median_price_per_sqm")


def with_generated_at(df: DataFrame) -> DataFrame:
    return df.select(F.current_timestamp().alias("generated_at"), "*")


def city_summary(fact: DataFrame, dim_city: DataFrame) -> DataFrame:
    """Per city: listings, avg price, median area, avg rooms, avg price per m².

    dim_city is one row per city: AQE broadcasts it from its measured size (a shuffle join beyond the
    threshold); the aggregate is partial per task before the shuffle on city.
    """
    j = fact.join(dim_city.select("city_key", "city"), "city_key", "inner") \
        .select("city", "price", "area_sqm", "num_rooms", "price_per_sqm_calculated")
    j = written(j, "city-listings")  # read by the aggregate and by the count of values near the medians
    out = quantiles(j, {"median_area_sqm": "area_sqm"}, ["city"], also=[
        F.count(F.lit(1)).alias("num_listings"),
        round2(F.avg("price")).alias("avg_price"),
        round2(F.avg("num_rooms")).alias("avg_rooms"),
        round2(F.avg("price_per_sqm_calculated")).alias("avg_price_per_sqm"),
    ])
    return out.select("city", "num_listings", "avg_price", "median_area_sqm", "avg_rooms", "avg_price_per_sqm")


def district_summary(fact: DataFrame, dim_district: DataFrame) -> DataFrame:
    """Per (city, district), Unknown excluded, with dense ranks on the rounded avg price per m².

    The rank is global, but it runs over the aggregate (one row per district), not over listings.
    """
    d = dim_district.filter(F.col("district") != UNKNOWN).select("district_key", "city", "district")
    j = fact.join(d, "district_key", "inner")
    agg = j.groupBy("city", "district").agg(
        F.count(F.lit(1)).alias("num_listings"),
        round2(F.avg("price")).alias("avg_price"),
        round2(F.avg("price_per_sqm_calculated")).alias("avg_price_per_sqm"),
    )
    return agg.select(
        "*",
        F.dense_rank().over(Window.orderBy(F.col("avg_price_per_sqm").desc())).alias("rank_most_expensive"),
        F.dense_rank().over(Window.orderBy(F.col("avg_price_per_sqm").asc())).alias("rank_cheapest"),
    )


PERIODS = ("day", "week", "month")


def market_trends(daily: DataFrame) -> DataFrame:
    """Day / ISO-week (Monday) / month averages over listing-days, with period-over-period change.

    One scan: each daily row is exploded into its three (period_type, period_start) pairs and a single
    grouped aggregate (partial before the shuffle) produces all grains. Growth uses the unrounded
    averages and rounds last; the lag window runs over the small aggregate.
    """
    day = utc_day("date_collected")
    periods = F.array(
        F.struct(F.lit("day").alias("period_type"), day.alias("period_start")),
        F.struct(F.lit("week").alias("period_type"), F.to_date(F.date_trunc("week", F.col("date_collected"))).alias("period_start")),
        F.struct(F.lit("month").alias("period_type"), F.to_date(F.date_trunc("month", F.col("date_collected"))).alias("period_start")),
    )
    x = daily.select(F.explode(periods).alias("p"), "price", "price_per_sqm_calculated")
    agg = x.groupBy(F.col("p.period_type").alias("period_type"), F.col("p.period_start").alias("period_start")).agg(
        F.avg("price").alias("_avg_price"),
        F.avg("price_per_sqm_calculated").alias("_avg_ppsm"),
        F.count(F.lit(1)).alias("num_listings"),
    )
    w = Window.partitionBy("period_type").orderBy("period_start")
    prev = F.lag("_avg_price").over(w)
    return agg.select(
        "period_type", "period_start",
        round2(F.col("_avg_price")).alias("avg_price"),
        round2(F.col("_avg_ppsm")).alias("avg_price_per_sqm"),
        "num_listings",
        round2(F.col("_avg_price") - prev).alias("price_change_abs"),
        round2(safe_ratio(F.col("_avg_price") - prev, prev) * 100).alias("price_change_pct"),
    )
