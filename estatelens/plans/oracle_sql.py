"""DuckDB twins of the registered queries (the correctness oracle).

Each query is one SELECT over the driver's pre-registered views. The adapters are restated here as
CTEs with the same arithmetic (every double literal typed as DOUBLE so both engines compute the same
IEEE values). Conventions shared with the Spark side:

* rounding: ``CAST(round(CAST(x AS DECIMAL(38,10)), 2) AS DOUBLE)``
* surrogate key: md5 of the '-'-joined string forms, null replaced by the placeholder
* word capitalisation: character-wise, upper after a delimiter (DuckDB has no initcap)
* medians: ``quantile_disc(x, 0.5)`` (= percentile_disc)
"""

from __future__ import annotations

from ..functions.keys import NULL_KEY_PLACEHOLDER
from ..functions.text import INITCAP_DELIMITERS

NULL_PH = f"'{NULL_KEY_PLACEHOLDER}'"
DELIMS = "[" + "".join("\\" + ch if ch in "[]\\^-" else ch for ch in INITCAP_DELIMITERS) + "]"


def r2(x: str) -> str:
    return f"CAST(round(CAST(({x}) AS DECIMAL(38,10)), 2) AS DOUBLE)"


def sk(*exprs: str) -> str:
    parts = " || '-' || ".join(f"coalesce(CAST(({e}) AS VARCHAR), {NULL_PH})" for e in exprs)
    return f"md5({parts})"


def initcap(x: str) -> str:
    return (f"CASE WHEN ({x}) IS NULL THEN NULL ELSE array_to_string(list_transform(string_split(({x}), ''), "
            f"lambda c, i: CASE WHEN i = 1 OR regexp_matches(string_split(({x}), '')[i - 1], '^(?:{DELIMS}|\\s)$') "
            f"THEN upper(c) ELSE lower(c) END), '') END")


def dkey(x: str) -> str:
    return f"CAST(year(CAST(({x}) AS DATE)) * 10000 + month(CAST(({x}) AS DATE)) * 100 + day(CAST(({x}) AS DATE)) AS INTEGER)"


def utc_ts(x: str) -> str:
    return f"CAST(TRY_CAST(({x}) AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP)"


GEO = """geo AS (
  SELECT n_nationkey, n_name, n_regionkey, r_name,
         lower(replace(n_name, '_', '-')) || '-' || lower(replace(r_name, ' ', '-')) AS source_city
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

LOOKUP = """lookup AS (
  SELECT source_city, 'Miasto ' || CAST(n_nationkey AS VARCHAR) AS city_name, lower(r_name) AS voivodeship,
         n_regionkey = 3 AS is_mvp,
         CAST(40 + n_nationkey AS DOUBLE) AS bbox_lat_min, 40 + n_nationkey + 0.45::DOUBLE AS bbox_lat_max,
         CAST(10 + n_regionkey AS DOUBLE) AS bbox_lon_min, 10 + n_regionkey + 0.29::DOUBLE AS bbox_lon_max
  FROM geo WHERE n_nationkey % 6 <> 5)"""

EV = """ev AS (
  SELECT e.event_id, e.ts, e.user_id, e.event_type, e.value,
         CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS k,
         c.c_nationkey, c.c_mktsegment, g.n_nationkey, g.n_name, g.n_regionkey, g.r_name, g.source_city
  FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN geo g ON c.c_nationkey = g.n_nationkey)"""

RAW = """raw AS (
  SELECT user_id AS id,
    'https://listings.example/ad/' || CAST(user_id AS VARCHAR) AS url,
    event_type || ' flat ' || CAST(user_id AS VARCHAR) AS title,
    CASE WHEN event_id % 13 = 0 THEN 'n/a'
         ELSE strftime(ts - INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S') || '+02:00' END AS created_time,
    ts AS date_collected,
    n_name AS city,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE c_mktsegment END AS district,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE 40 + n_nationkey + (event_id % 50) / 100.0::DOUBLE END AS latitude,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE 10 + n_regionkey + (event_id % 30) / 100.0::DOUBLE END AS longitude,
    value AS price,
    'PLN' AS currency,
    CAST(k AS DOUBLE) AS area_sqm,
    CASE WHEN event_id % 3 = 0 THEN NULL ELSE k * 10.0::DOUBLE END AS extra_rent_pln,
    CAST(1 + k % 6 AS BIGINT) AS num_rooms,
    k % 6 = 5 AS rooms_capped,
    CAST(CASE WHEN k % 13 = 12 THEN NULL ELSE k % 13 END AS BIGINT) AS floor,
    k % 13 = 11 AS floor_capped,
    CASE WHEN event_type = 'error' THEN NULL ELSE event_type IN ('view', 'purchase') END AS is_furnished,
    CASE event_type WHEN 'view' THEN 'blok' WHEN 'click' THEN 'kamienica' WHEN 'purchase' THEN 'apartamentowiec'
                    WHEN 'signup' THEN 'dom wolnostojacy' END AS building_type,
    CASE WHEN event_type = 'purchase' THEN 'primary' WHEN event_type = 'signup' THEN NULL ELSE 'secondary' END
      AS market_type,
    CASE WHEN k = 0 THEN NULL WHEN event_id % 41 = 0 THEN value / k * 1.2::DOUBLE ELSE value / k END
      AS price_per_sqm_listed,
    source_city
  FROM ev)"""

RENAMED = f"""renamed AS (
  SELECT {sk('r.id')} AS listing_key, r.id AS listing_id, r.url, r.title,
    {utc_ts('r.created_time')} AS date_published,
    r.date_collected,
    coalesce(l.city_name, {initcap('r.source_city')}) AS city,
    r.source_city AS source_city_raw,
    r.district, r.latitude, r.longitude, r.price, r.currency, r.area_sqm, r.extra_rent_pln,
    r.num_rooms, r.rooms_capped, r.floor, r.floor_capped, r.is_furnished, r.building_type,
    r.market_type, r.price_per_sqm_listed
  FROM raw r LEFT JOIN lookup l ON r.source_city = l.source_city)"""

FILTERED = """filtered AS (
  SELECT * FROM renamed
  WHERE listing_id IS NOT NULL AND price BETWEEN 1 AND 20000000 AND area_sqm BETWEEN 10 AND 500)"""

STG = """stg AS (
  SELECT * FROM filtered
  QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY date_collected DESC) = 1)"""

DAILY = f"""daily AS (
  SELECT listing_id, date_collected, city, price, area_sqm, price_per_sqm_calculated FROM (
    SELECT r.id AS listing_id, r.date_collected,
           coalesce(l.city_name, {initcap('r.source_city')}) AS city,
           r.price, r.area_sqm,
           {r2('r.price / nullif(r.area_sqm, 0)')} AS price_per_sqm_calculated
    FROM raw r LEFT JOIN lookup l ON r.source_city = l.source_city) x
  WHERE listing_id IS NOT NULL AND price BETWEEN 1 AND 20000000 AND area_sqm BETWEEN 10 AND 500
  QUALIFY row_number() OVER (PARTITION BY listing_id, CAST(date_collected AS DATE)
                             ORDER BY date_collected DESC) = 1)"""

FACT = f"""fact AS (
  SELECT listing_key, listing_id,
    {sk('city')} AS city_key,
    {sk('city', "coalesce(district, 'Unknown')")} AS district_key,
    {sk("coalesce(building_type, 'Unknown')")} AS building_type_key,
    {sk("coalesce(market_type, 'Unknown')")} AS market_key,
    {dkey('date_collected')} AS date_collected_key,
    CASE WHEN date_published IS NOT NULL THEN {dkey('date_published')} END AS date_published_key,
    price, currency, area_sqm, price_per_sqm_listed,
    {r2('price / nullif(area_sqm, 0)')} AS price_per_sqm_calculated,
    num_rooms, rooms_capped, floor, floor_capped, is_furnished, extra_rent_pln, latitude, longitude, url
  FROM stg)"""

DIM_CITY = f"""dim_city AS (
  SELECT {sk('d.city')} AS city_key, d.city, l.voivodeship, coalesce(l.is_mvp, false) AS is_mvp
  FROM (SELECT DISTINCT city FROM stg) d LEFT JOIN lookup l ON d.city = l.city_name)"""

DIM_DISTRICT = f"""dim_district AS (
  SELECT {sk('city', 'district')} AS district_key, city, district
  FROM (SELECT DISTINCT city, coalesce(district, 'Unknown') AS district FROM stg))"""

DIM_BUILDING = f"""dim_building_type AS (
  SELECT {sk('building_type')} AS building_type_key, building_type
  FROM (SELECT DISTINCT coalesce(building_type, 'Unknown') AS building_type FROM stg))"""

DIM_MARKET = f"""dim_market AS (
  SELECT {sk('market_type')} AS market_key, market_type
  FROM (SELECT DISTINCT coalesce(market_type, 'Unknown') AS market_type FROM stg))"""

BASE = [GEO, LOOKUP, EV, RAW, RENAMED, FILTERED, STG]


def with_ctes(ctes, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def stg_q(select: str, *extra) -> str:
    return with_ctes(BASE + list(extra), select)


PRICE_STATS = """SELECT count(*) AS total_listings,
  {avg_price} AS avg_price,
  quantile_disc(price, 0.5) AS median_price,
  min(price) AS min_price, max(price) AS max_price,
  {stddev} AS stddev_price,
  {avg_ppsm} AS avg_price_per_sqm,
  quantile_disc(price_per_sqm_calculated, 0.5) AS median_price_per_sqm
FROM fact""".format(avg_price=r2("avg(price)"), stddev=r2("stddev_samp(price)"),
                    avg_ppsm=r2("avg(price_per_sqm_calculated)"))

CITY_SUMMARY = """SELECT c.city, count(*) AS num_listings, {avg_price} AS avg_price,
  quantile_disc(f.area_sqm, 0.5) AS median_area_sqm, {avg_rooms} AS avg_rooms, {avg_ppsm} AS avg_price_per_sqm
FROM fact f JOIN dim_city c ON f.city_key = c.city_key
GROUP BY c.city""".format(avg_price=r2("avg(f.price)"), avg_rooms=r2("avg(f.num_rooms)"),
                         avg_ppsm=r2("avg(f.price_per_sqm_calculated)"))

DISTRICT_AGG = f"""district_agg AS (
  SELECT d.city, d.district, count(*) AS num_listings, {r2('avg(f.price)')} AS avg_price,
         {r2('avg(f.price_per_sqm_calculated)')} AS avg_price_per_sqm
  FROM fact f JOIN dim_district d ON f.district_key = d.district_key
  WHERE d.district <> 'Unknown'
  GROUP BY d.city, d.district)"""

DISTRICT_SUMMARY = """SELECT *, CAST(dense_rank() OVER (ORDER BY avg_price_per_sqm DESC) AS INTEGER) AS rank_most_expensive,
  CAST(dense_rank() OVER (ORDER BY avg_price_per_sqm ASC) AS INTEGER) AS rank_cheapest
FROM district_agg"""

TRENDS = f"""trends AS (
  SELECT period_type, period_start,
    {r2('avg_price')} AS avg_price, {r2('avg_ppsm')} AS avg_price_per_sqm, num_listings,
    {r2('avg_price - lag(avg_price) OVER w')} AS price_change_abs,
    {r2('(avg_price - lag(avg_price) OVER w) / nullif(lag(avg_price) OVER w, 0) * 100')} AS price_change_pct
  FROM (
    SELECT 'day' AS period_type, CAST(date_collected AS DATE) AS period_start, avg(price) AS avg_price,
           avg(price_per_sqm_calculated) AS avg_ppsm, count(*) AS num_listings FROM daily GROUP BY 2
    UNION ALL
    SELECT 'week', CAST(date_trunc('week', date_collected) AS DATE), avg(price), avg(price_per_sqm_calculated),
           count(*) FROM daily GROUP BY 2
    UNION ALL
    SELECT 'month', CAST(date_trunc('month', date_collected) AS DATE), avg(price), avg(price_per_sqm_calculated),
           count(*) FROM daily GROUP BY 2) u
  WINDOW w AS (PARTITION BY period_type ORDER BY period_start))"""


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["src_city_lookup"] = with_ctes([GEO, LOOKUP], "SELECT * FROM lookup")
    q["stg_renamed"] = with_ctes(BASE[:5], "SELECT * FROM renamed")
    q["stg_city_standard"] = with_ctes(BASE[:5], "SELECT listing_id, date_collected, source_city_raw, city FROM renamed")
    q["stg_published_ts"] = with_ctes(
        BASE[:4], f"SELECT id AS listing_id, date_collected, created_time, {utc_ts('created_time')} AS date_published FROM raw")
    q["stg_filtered"] = with_ctes(BASE[:6], "SELECT * FROM filtered")
    q["stg_listings"] = stg_q("SELECT * FROM stg")
    q["surrogate_keys"] = stg_q("SELECT listing_key, listing_id, city_key, district_key, building_type_key, market_key FROM fact", FACT)
    q["ppsm_rows"] = with_ctes(BASE[:4], f"""SELECT id AS listing_id, date_collected, price, area_sqm,
        {r2('price / nullif(area_sqm, 0)')} AS price_per_sqm_calculated FROM raw""")
    q["int_listings_daily"] = with_ctes(BASE[:4] + [DAILY], "SELECT * FROM daily")
    q["dim_city"] = stg_q("SELECT * FROM dim_city", DIM_CITY)
    q["dim_district"] = stg_q("SELECT * FROM dim_district", DIM_DISTRICT)
    q["dim_building_type"] = stg_q("SELECT * FROM dim_building_type", DIM_BUILDING)
    q["dim_market"] = stg_q("SELECT * FROM dim_market", DIM_MARKET)
    q["fact_apartments"] = stg_q("SELECT * FROM fact", FACT)
    q["mart_price_statistics"] = stg_q(PRICE_STATS, FACT)
    q["mart_city_summary"] = stg_q(CITY_SUMMARY, FACT, DIM_CITY)
    q["mart_district_summary"] = stg_q(DISTRICT_SUMMARY, FACT, DIM_DISTRICT, DISTRICT_AGG)
    q["mart_market_trends"] = with_ctes(BASE[:4] + [DAILY, TRENDS], "SELECT * FROM trends")
    return q
