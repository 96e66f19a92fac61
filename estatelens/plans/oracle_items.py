"""DuckDB twins for normalisation (B) and linkage (C).

The oracle does not parse anything: it computes, from the driver columns, the labels the adapter
wrote into the items / capture documents and the typed values they must decode to.
"""

from __future__ import annotations

from . import params
from .oracle_sql import EV, GEO, LOOKUP, with_ctes

IT = """it AS (
  SELECT source_city, DATE '2024-01-31' AS batch_date, event_id AS seq,
    CAST(CASE WHEN event_id % 89 = 0 THEN -(n_nationkey + 1000) ELSE event_id END AS BIGINT) AS id,
    'https://listings.example/ad/' || CAST(event_id AS VARCHAR) AS url,
    event_type || ' flat' AS title,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+02:00' AS created_time,
    n_name AS city,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE c_mktsegment END AS district,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE 40 + n_nationkey + (event_id % 50) / 100.0::DOUBLE END AS latitude,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE 10 + n_regionkey + (event_id % 30) / 100.0::DOUBLE END AS longitude,
    value * 1000 AS price, 'PLN' AS currency,
    CAST(k // 2 AS VARCHAR) || CASE WHEN k % 2 = 1 THEN ',5' ELSE '' END || ' m²' AS m,
    k * 0.5::DOUBLE AS area_sqm,
    CAST(k AS VARCHAR) || '0 zł' AS rent, k * 10.0::DOUBLE AS extra_rent_pln,
    CAST(CAST(trunc(value * 10) AS BIGINT) AS VARCHAR) || ' zł/m²' AS price_per_m,
    CAST(CAST(trunc(value * 10) AS BIGINT) AS DOUBLE) AS price_per_sqm_listed,
    CASE WHEN k % 7 = 0 THEN 'Kawalerka' WHEN k % 7 = 6 THEN '4 i więcej' WHEN k % 7 = 5 THEN '10 pokoi i więcej'
         ELSE CAST(k % 7 AS VARCHAR) || ' pokoje' END AS rooms,
    CAST(CASE WHEN k % 7 = 0 THEN 1 WHEN k % 7 = 6 THEN 4 WHEN k % 7 = 5 THEN 10 ELSE k % 7 END AS BIGINT) AS num_rooms,
    k % 7 IN (5, 6) AS rooms_capped,
    CASE WHEN k % 12 = 0 THEN 'Parter' WHEN k % 12 = 11 THEN 'Powyżej 10' WHEN k % 12 = 10 THEN 'floor_select'
         ELSE CAST(k % 12 AS VARCHAR) END AS floor_select,
    CAST(CASE WHEN k % 12 = 0 THEN 0 WHEN k % 12 = 11 THEN 10 WHEN k % 12 = 10 THEN NULL ELSE k % 12 END AS BIGINT) AS floor,
    k % 12 = 11 AS floor_capped,
    CASE event_type WHEN 'view' THEN 'Tak' WHEN 'click' THEN 'Nie' ELSE 'furniture' END AS furniture,
    event_type = 'view' AS is_furnished,
    CASE event_type WHEN 'purchase' THEN 'Pierwotny' WHEN 'view' THEN 'Wtórny' WHEN 'click' THEN 'wtórny '
         WHEN 'signup' THEN 'Inny' ELSE 'market' END AS market,
    CASE WHEN event_type = 'purchase' THEN 'primary' WHEN event_type IN ('view', 'click') THEN 'secondary' END AS market_type,
    CASE WHEN event_type = 'error' THEN 'builttype' ELSE 'Blok' END AS builttype,
    CASE WHEN event_type = 'error' THEN 'builttype' ELSE 'Blok' END AS building_type,
    event_id % 31 = 0 AS malformed
  FROM ev)"""

RAW_COLS = ["id", "url", "title", "created_time", "date_collected", "city", "district", "latitude", "longitude",
            "price", "currency", "area_sqm", "extra_rent_pln", "num_rooms", "rooms_capped", "floor", "floor_capped",
            "is_furnished", "building_type", "market_type", "price_per_sqm_listed", "source_city"]


def fold(x: str) -> str:
    return f"lower(trim(strip_accents(replace(replace({x}, 'ł', 'l'), 'Ł', 'L'))))"


ENT = f"""sup AS (
  SELECT s.s_suppkey, s.s_nationkey,
         CASE WHEN s.s_suppkey % 7 = 0 THEN (n.n_regionkey + 1) % 5 ELSE n.n_regionkey END AS rk
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey),
ent AS (
  SELECT CAST(CASE WHEN s_suppkey % 5 = 0 THEN s_suppkey * 10 + 1 ELSE (s_suppkey // 4) * 10 END AS BIGINT) AS doc_id,
         s_suppkey, CAST(s_nationkey * 10 + s_suppkey % 3 AS BIGINT) AS city_id,
         CASE s_suppkey % 3 WHEN 0 THEN 'Miasto ' || CAST(s_nationkey AS VARCHAR)
              WHEN 1 THEN 'MIASTÓ ' || CAST(s_nationkey AS VARCHAR) ELSE ' miaśto ' || CAST(s_nationkey AS VARCHAR) END
           AS city_name,
         CAST(CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE rk END AS BIGINT) AS region_id, r_name AS region_name
  FROM sup JOIN region ON rk = r_regionkey),
entries AS (
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY s_suppkey) - 1 AS BIGINT) AS pos,
         city_id, city_name, region_id, region_name
  FROM ent WHERE NOT (doc_id % 10 = 0 AND (doc_id // 10) % 13 = 7)),
cands AS (
  SELECT doc_id, pos, city_id, city_name, region_id, region_name,
         {fold("coalesce(city_name, '')")} AS name_norm, {fold("coalesce(region_name, '')")} AS region_norm
  FROM entries WHERE city_id IS NOT NULL AND region_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY city_id, region_id ORDER BY doc_id, pos) = 1)"""

MATCH = f"""tg AS (
  SELECT source_city, {fold('city_name')} AS name_norm, {fold('voivodeship')} AS t_region_norm FROM lookup),
jm AS (
  SELECT tg.source_city, c.doc_id, c.pos, c.city_id, c.region_id, c.city_name, c.region_name,
         c.region_norm = tg.t_region_norm AS in_region
  FROM tg LEFT JOIN cands c ON tg.name_norm = c.name_norm),
agg AS (
  SELECT source_city, count(city_id) AS n_candidates,
         CAST(sum(CASE WHEN in_region THEN 1 ELSE 0 END) AS BIGINT) AS n_in_region
  FROM jm GROUP BY source_city),
firstm AS (
  SELECT * FROM jm
  QUALIFY row_number() OVER (PARTITION BY source_city ORDER BY CASE WHEN in_region THEN 0 ELSE 1 END, doc_id, pos) = 1),
matches AS (
  SELECT f.source_city,
         CASE WHEN a.n_candidates = 0 THEN 'MISS' WHEN a.n_in_region = 1 THEN 'OK' WHEN a.n_in_region > 1 THEN 'AMBIGUOUS'
              WHEN a.n_candidates = 1 THEN 'FALLBACK' ELSE 'AMBIGUOUS' END AS status,
         CASE WHEN a.n_candidates > 0 THEN f.city_id END AS city_id,
         CASE WHEN a.n_candidates > 0 THEN f.region_id END AS region_id,
         CASE WHEN a.n_candidates > 0 THEN concat_ws(', ', f.city_name, f.region_name) END AS matched_label,
         CAST(a.n_candidates AS BIGINT) AS n_candidates, a.n_in_region
  FROM firstm f JOIN agg a ON f.source_city = a.source_city)"""


def build() -> dict[str, str]:
    base = [GEO, EV, IT]
    good = "FROM it WHERE NOT malformed"
    q = {
        "norm_flatten": with_ctes(base, "SELECT source_city, batch_date, seq, id, url, title, created_time, city, "
                                        f"district, latitude, longitude {good}"),
        "norm_params": with_ctes(base, "SELECT source_city, seq, id, price, currency, m, rent, price_per_m, rooms, "
                                       f"floor_select, furniture, market, builttype {good}"),
        "norm_area": with_ctes(base, f"SELECT seq, id, m, area_sqm, rent, extra_rent_pln {good}"),
        "norm_rooms": with_ctes(base, f"SELECT seq, rooms, num_rooms, rooms_capped {good}"),
        "norm_floor": with_ctes(base, f"SELECT seq, floor_select, floor, floor_capped {good}"),
        "norm_bool": with_ctes(base, f"SELECT seq, furniture, is_furnished {good}"),
        "norm_market": with_ctes(base, f"SELECT seq, market, market_type {good}"),
        "norm_ppsm": with_ctes(base, f"SELECT seq, price_per_m, price_per_sqm_listed {good}"),
        "norm_malformed_count": with_ctes(base, "SELECT source_city, batch_date, count(*) AS items, "
                                                "CAST(sum(CASE WHEN malformed THEN 1 ELSE 0 END) AS BIGINT) AS malformed "
                                                "FROM it GROUP BY source_city, batch_date"),
    }
    cols = ", ".join("TIMESTAMP '" + params.COLLECTED_AT + "' AS date_collected" if c == "date_collected" else c
                     for c in RAW_COLS)
    q["dedup_last_wins"] = with_ctes(base, f"SELECT {cols}, batch_date, seq {good} "
                                           "QUALIFY row_number() OVER (PARTITION BY source_city, batch_date, id "
                                           "ORDER BY seq DESC) = 1")
    q["text_fold"] = with_ctes([ENT], f"SELECT doc_id, pos, city_name, {fold('city_name')} AS city_norm, region_name, "
                                      f"{fold('region_name')} AS region_norm FROM entries")
    q["link_candidates"] = with_ctes([ENT], "SELECT * FROM cands")
    link = [GEO, LOOKUP, ENT, MATCH]
    q["link_match"] = with_ctes(link, "SELECT * FROM matches")
    q["link_report"] = with_ctes(link, "SELECT status, count(*) AS targets FROM matches GROUP BY status")
    q["link_unmapped"] = with_ctes(link, """SELECT g.source_city, m.source_city IS NOT NULL AS mapped,
        CASE WHEN m.source_city IS NULL THEN 'free_text' ELSE 'location_id' END AS search_mode
        FROM geo g LEFT JOIN (SELECT source_city FROM matches WHERE status <> 'MISS') m ON g.source_city = m.source_city""")
    return q


def build_sources() -> dict[str, str]:
    base = [GEO, EV, IT]
    cols = ", ".join("TIMESTAMP '" + params.COLLECTED_AT + "' AS date_collected" if c == "date_collected" else c
                     for c in RAW_COLS)
    landed = with_ctes(base, f"SELECT {cols}, batch_date FROM it WHERE NOT malformed "
                             "QUALIFY row_number() OVER (PARTITION BY source_city, batch_date, id ORDER BY seq DESC) = 1")
    twice = with_ctes(base + [f"""landed AS (SELECT {cols} FROM it WHERE NOT malformed
        QUALIFY row_number() OVER (PARTITION BY source_city, batch_date, id ORDER BY seq DESC) = 1)"""],
                      "SELECT * FROM landed UNION ALL SELECT * FROM landed")
    return {
        "sink_landing_roundtrip": landed,
        "src_batch_rows": landed,
        "src_batch_status": f"""SELECT source_city, batch_date, "rows", CASE WHEN source_city = '{params.SUBSET_CITIES[0]}' THEN 1 ELSE 0 END AS corrupt_records,
            source_city <> '{params.SUBSET_CITIES[0]}' AS readable, CASE WHEN source_city = '{params.SUBSET_CITIES[0]}' THEN 0 ELSE "rows" END AS loaded
            FROM (SELECT source_city, batch_date, count(*) AS "rows" FROM ({landed}) x GROUP BY source_city, batch_date) y""",
        "sink_raw_append": twice,
        "src_city_lookup": with_ctes([GEO, LOOKUP], "SELECT * FROM lookup"),
    }
