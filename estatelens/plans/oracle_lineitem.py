"""DuckDB twins for the lineitem-adapter queries (seven years of scrapes, ties broken by line keys)."""

from __future__ import annotations

from .oracle_sql import (CITY_SUMMARY, DIM_CITY, DIM_DISTRICT, DISTRICT_AGG, DISTRICT_SUMMARY, FACT, FILTERED, GEO, LOOKUP, PRICE_STATS, RENAMED, TRENDS, initcap,
                         r2, with_ctes)

TIE = ["l_linenumber", "l_partkey", "l_suppkey"]
TIE_DESC = ", ".join(f"{c} DESC" for c in TIE)

LI_RAW = """raw AS (
  SELECT l.l_orderkey AS id, 'https://listings.example/ad/' || CAST(l.l_orderkey AS VARCHAR) AS url,
    CAST(NULL AS VARCHAR) AS title, CAST(NULL AS VARCHAR) AS created_time, l.l_shipdate AS date_collected,
    g.n_name AS city, CASE WHEN l.l_linenumber = 1 THEN NULL ELSE l.l_returnflag END AS district,
    CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude, l.l_extendedprice AS price,
    'PLN' AS currency, l.l_quantity + 10.0::DOUBLE AS area_sqm, CAST(NULL AS DOUBLE) AS extra_rent_pln,
    CAST(l.l_linenumber AS BIGINT) AS num_rooms, false AS rooms_capped, CAST(NULL AS BIGINT) AS floor,
    false AS floor_capped, CAST(NULL AS BOOLEAN) AS is_furnished, CAST(NULL AS VARCHAR) AS building_type,
    CASE WHEN l.l_discount > 0.05::DOUBLE THEN 'primary' ELSE 'secondary' END AS market_type,
    l.l_extendedprice / (l.l_quantity + 10.0::DOUBLE) AS price_per_sqm_listed, g.source_city,
    l.l_linenumber, l.l_partkey, l.l_suppkey
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN geo g ON s.s_nationkey = g.n_nationkey)"""

LI_RENAMED = RENAMED.replace("r.market_type, r.price_per_sqm_listed\n",
                             "r.market_type, r.price_per_sqm_listed, r.l_linenumber, r.l_partkey, r.l_suppkey\n")

LI_STG = f"""stg AS (
  SELECT * EXCLUDE (l_linenumber, l_partkey, l_suppkey, _rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY date_collected DESC, {TIE_DESC}) AS _rn
    FROM filtered) WHERE _rn = 1)"""

LI_DAILY = f"""daily AS (
  SELECT listing_id, date_collected, city, price, area_sqm, price_per_sqm_calculated FROM (
    SELECT x.*, row_number() OVER (PARTITION BY listing_id, CAST(date_collected AS DATE)
                                   ORDER BY date_collected DESC, {TIE_DESC}) AS _rn
    FROM (SELECT r.id AS listing_id, r.date_collected,
                 coalesce(l.city_name, {initcap('r.source_city')}) AS city,
                 r.price, r.area_sqm, {r2('r.price / nullif(r.area_sqm, 0)')} AS price_per_sqm_calculated,
                 r.l_linenumber, r.l_partkey, r.l_suppkey
          FROM raw r LEFT JOIN lookup l ON r.source_city = l.source_city) x
    WHERE listing_id IS NOT NULL AND price BETWEEN 1 AND 20000000 AND area_sqm BETWEEN 10 AND 500) y
  WHERE _rn = 1)"""

BASE_LI = [GEO, LOOKUP, LI_RAW, LI_RENAMED, FILTERED, LI_STG]


def build() -> dict[str, str]:
    assert LI_RENAMED != RENAMED
    return {
        "li_stg_listings": with_ctes(BASE_LI, "SELECT * FROM stg"),
        "li_market_trends": with_ctes([GEO, LOOKUP, LI_RAW, LI_DAILY, TRENDS], "SELECT * FROM trends"),
        "li_city_summary": with_ctes(BASE_LI + [FACT, DIM_CITY], CITY_SUMMARY),
        "li_district_summary": with_ctes(BASE_LI + [FACT, DIM_DISTRICT, DISTRICT_AGG], DISTRICT_SUMMARY),
        "li_price_statistics": with_ctes(BASE_LI + [FACT], PRICE_STATS),
    }
