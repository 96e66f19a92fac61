"""Model-specific data tests (singular assertions) and the project's full check suite."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import price_per_sqm_expr, safe_ratio
from ..operators import checks as C
from ..session import small, written
from . import marts, star

PRICE_MAX = 20_000_000
PPSM_TOLERANCE = 0.05


def price_within_bounds(stg: DataFrame) -> DataFrame:
    p = F.col("price")
    return stg.filter(p.isNull() | (p <= 0) | (p > PRICE_MAX)).select("listing_id", "price")


def area_within_bounds(stg: DataFrame) -> DataFrame:
    a = F.col("area_sqm")
    return stg.filter(a.isNull() | (a < 10) | (a > 500)).select("listing_id", "area_sqm")


def price_per_sqm_consistent(stg: DataFrame) -> DataFrame:
    """Listed vs computed price per m² more than 5 % apart (a listed value of 0 cannot be judged)."""
    listed, area = F.col("price_per_sqm_listed"), F.col("area_sqm")
    gap = safe_ratio(F.abs(safe_ratio(F.col("price"), area) - listed), listed)
    return stg.filter(listed.isNotNull() & area.isNotNull() & (area != 0) & (gap > PPSM_TOLERANCE)).select(
        "listing_id", "price", "area_sqm", "price_per_sqm_listed",
        price_per_sqm_expr().alias("price_per_sqm_calculated"))


def geo_within_city_bounds(stg: DataFrame, lookup: DataFrame) -> DataFrame:
    """Listings whose coordinates fall outside their city's box: equi join on the city (seed rows are
    one per target city, broadcast) plus a range predicate; null coordinates are not judged."""
    box = small(lookup.select(F.col("city_name"), "bbox_lat_min", "bbox_lat_max", "bbox_lon_min", "bbox_lon_max"))
    j = stg.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()) \
        .join(box, F.col("city") == F.col("city_name"), "inner")
    lat, lon = F.col("latitude"), F.col("longitude")
    out = (lat < F.col("bbox_lat_min")) | (lat > F.col("bbox_lat_max")) | (lon < F.col("bbox_lon_min")) | (lon > F.col("bbox_lon_max"))
    return j.filter(out).select("listing_id", "city", "latitude", "longitude")


def mart_reconciles(city_summary: DataFrame, stg: DataFrame) -> DataFrame:
    """One row when the mart's listing total differs from the staging count (two 1-row aggregates
    joined on a constant key)."""
    m = city_summary.agg(F.sum("num_listings").cast("long").alias("mart_count")).withColumn("_k", F.lit(1))
    s = stg.agg(F.count(F.lit(1)).alias("stg_count")).withColumn("_k", F.lit(1))
    return m.join(s, "_k").filter(~F.col("mart_count").eqNullSafe(F.col("stg_count"))).select("mart_count", "stg_count")


def declared(geo_severity: str = "error") -> list[C.Declared]:
    """Every test declared for the sources, seed, models and marts, and the singular ones."""
    D = C.Declared

    def of(model: str, unique: tuple = (), not_null: tuple = ()) -> list[C.Declared]:
        return [D("unique", model, (c,)) for c in unique] + [D("not_null", model, (c,)) for c in not_null]

    def fk(model: str, column: str, to: str, field: str, where: str | None = None) -> C.Declared:
        return D("relationships", model, (column,), to=to, field=field, where=where)

    boxes = ("bbox_lat_min", "bbox_lat_max", "bbox_lon_min", "bbox_lon_max")
    dims = {"city_key": "dim_city", "district_key": "dim_district", "building_type_key": "dim_building_type", "market_key": "dim_market"}
    return [
        *of("raw", not_null=("id", "source_city")),
        *of("city_lookup", ("source_city",), ("source_city", "city_name", "voivodeship", "is_mvp", *boxes)),
        D("expression_is_true", "city_lookup", expression="bbox_lat_min < bbox_lat_max and bbox_lon_min < bbox_lon_max"),
        *of("stg_listings", ("listing_key", "listing_id"), ("listing_key", "listing_id", "city", "price", "area_sqm")),
        fk("stg_listings", "city", "city_lookup", "city_name"),
        D("accepted_values", "stg_listings", ("market_type",), values=("primary", "secondary"), severity="warn"),
        *of("int_listings_daily", not_null=("listing_id", "date_collected", "price", "area_sqm")),
        *of("dim_city", ("city_key",), ("city_key", "city", "voivodeship", "is_mvp")),
        *of("dim_district", ("district_key",), ("district_key", "city", "district")),
        *of("dim_building_type", ("building_type_key",), ("building_type_key",)),
        *of("dim_market", ("market_key",), ("market_key",)),
        *of("dim_date", ("date_key", "date_day"), ("date_key", "date_day")),
        *of("fact_apartments", ("listing_key",), ("listing_key", *dims, "date_collected_key", "price", "area_sqm")),
        *[fk("fact_apartments", k, d, k) for k, d in dims.items()],
        fk("fact_apartments", "date_collected_key", "dim_date", "date_key"),
        fk("fact_apartments", "date_published_key", "dim_date", "date_key", where="date_published_key is not null"),
        *of("mart_price_statistics", not_null=("total_listings", "avg_price")),
        *of("mart_city_summary", ("city",), ("city", "num_listings")),
        fk("mart_city_summary", "city", "city_lookup", "city_name"),
        *of("mart_district_summary", not_null=("city", "district", "rank_most_expensive", "rank_cheapest")),
        D("unique_combination", "mart_district_summary", ("city", "district")),
        *of("mart_market_trends", not_null=("period_type", "period_start", "avg_price", "num_listings")),
        D("accepted_values", "mart_market_trends", ("period_type",), values=("day", "week", "month")),
        D("unique_combination", "mart_market_trends", ("period_type", "period_start")),
        D("assert_price_within_bounds", "stg_listings", expression=f"price > 0 and price <= {PRICE_MAX}"),
        D("assert_area_within_bounds", "stg_listings", expression="area_sqm >= 10 and area_sqm <= 500"),
        D("assert_price_per_sqm_consistent", "stg_listings", expression="price_per_sqm_listed is null or area_sqm is null or area_sqm = 0 or "
          f"coalesce(abs(price / area_sqm - price_per_sqm_listed) / nullif(price_per_sqm_listed, 0) <= {PPSM_TOLERANCE}D, true)"),
        D("assert_geo_within_city_bounds", "stg_listings", severity=geo_severity),
        D("assert_mart_city_summary_reconciles", "mart_city_summary"),
    ]


def frames(models: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Failing rows of the tests that join models; those whose models are missing are left out."""
    out = {}
    if "city_lookup" in models:
        out["assert_geo_within_city_bounds"] = geo_within_city_bounds(models["stg_listings"], models["city_lookup"])
    out["assert_mart_city_summary_reconciles"] = mart_reconciles(models["mart_city_summary"], models["stg_listings"])
    return out


def built_models(spark: SparkSession, raw: DataFrame, lookup: DataFrame, stg: DataFrame, daily: DataFrame, dim_date: DataFrame) -> dict[str, DataFrame]:
    """All models under test, each written once, so that tests read tables of known size."""
    stg, daily = written(stg, "check-stg"), written(daily, "check-daily")
    fact = written(star.fact(stg), "check-fact")
    dims = {"dim_city": star.dim_city(stg, lookup), "dim_district": star.dim_district(stg), "dim_building_type": star.dim_building_type(stg),
            "dim_market": star.dim_market(stg), "dim_date": dim_date, "city_lookup": lookup}
    out = {"raw": raw, "stg_listings": stg, "int_listings_daily": daily, "fact_apartments": fact} | {k: written(d, f"check-{k}") for k, d in dims.items()}
    made = {"mart_price_statistics": marts.price_statistics(fact), "mart_city_summary": marts.city_summary(fact, out["dim_city"]),
            "mart_district_summary": marts.district_summary(fact, out["dim_district"]), "mart_market_trends": marts.market_trends(daily)}
    return out | {k: written(d, f"check-{k}") for k, d in made.items()}
