"""DuckDB twins: day spine, incremental load / merge, history, data checks, reports."""

from __future__ import annotations

import datetime as dt

from . import params
from .oracle_sql import (BASE, DAILY, DIM_BUILDING, DIM_CITY, DIM_DISTRICT, DIM_MARKET,
                         DISTRICT_AGG, DISTRICT_SUMMARY, EV, FACT, FILTERED, GEO, LOOKUP, PRICE_STATS,
                         RAW, RENAMED, STG, TRENDS, CITY_SUMMARY, dkey, r2, with_ctes)

DIM_DATE = """dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date_day,
         CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
         strftime(d, '%B') AS month_name, CAST(day(d) AS INTEGER) AS day_of_month,
         CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name,
         CAST(weekofyear(d) AS INTEGER) AS iso_week_of_year, dayofweek(d) + 1 IN (1, 7) AS is_weekend
  FROM (SELECT CAST(t.range AS DATE) AS d
        FROM range(TIMESTAMP '2010-01-01', (SELECT max(CAST(ts AS DATE)) FROM events) + INTERVAL 1 YEAR,
                   INTERVAL 1 DAY) t))"""

CUT = params.INCREMENTAL_CUTOFF


def _target_ctes():
    """Target fact built from scrapes before the cutoff (same chain over a filtered raw)."""
    raw_t = "raw_t AS (SELECT * FROM raw WHERE date_collected < TIMESTAMP '" + CUT + "')"
    ren_t = RENAMED.replace("renamed AS", "renamed_t AS").replace("FROM raw r", "FROM raw_t r")
    fil_t = FILTERED.replace("filtered AS", "filtered_t AS").replace("FROM renamed", "FROM renamed_t")
    stg_t = STG.replace("stg AS", "stg_t AS").replace("FROM filtered", "FROM filtered_t")
    fact_t = FACT.replace("fact AS", "fact_t AS").replace("FROM stg)", "FROM stg_t)")
    return [raw_t, ren_t, fil_t, stg_t, fact_t]


SLICE = f"""slice AS (
  SELECT * FROM stg WHERE {dkey('date_collected')} >= (SELECT coalesce(max(date_collected_key), 0) FROM fact_t))"""
FACT_S = FACT.replace("fact AS", "fact_s AS").replace("FROM stg)", "FROM slice)")

FACT_COLS = ["listing_key", "listing_id", "city_key", "district_key", "building_type_key", "market_key",
             "date_collected_key", "date_published_key", "price", "currency", "area_sqm", "price_per_sqm_listed",
             "price_per_sqm_calculated", "num_rooms", "rooms_capped", "floor", "floor_capped", "is_furnished",
             "extra_rent_pln", "latitude", "longitude", "url"]


def _merge(url_expr: str) -> str:
    cols = ", ".join(url_expr if c == "url" else c for c in FACT_COLS)
    return (f"SELECT {cols} FROM fact_t WHERE listing_key NOT IN (SELECT listing_key FROM fact_s) "
            f"UNION ALL SELECT {', '.join(FACT_COLS)} FROM fact_s")


STG_DAILY = """sd AS (
  SELECT * FROM filtered
  QUALIFY row_number() OVER (PARTITION BY listing_id, CAST(date_collected AS DATE) ORDER BY date_collected DESC) = 1)"""

SNAP_COLS = "listing_key, listing_id, city, district, price, area_sqm, market_type, date_collected"


def backfill(end: dt.date) -> list[str]:
    e = f"DATE '{end.isoformat()}'"
    return [STG_DAILY, f"""bd AS (
  SELECT {SNAP_COLS}, CAST(date_collected AS DATE) AS _day,
         lead(CAST(date_collected AS DATE)) OVER (PARTITION BY listing_id ORDER BY CAST(date_collected AS DATE)) AS _next
  FROM sd WHERE CAST(date_collected AS DATE) <= {e})""", f"""bev AS (
  SELECT {SNAP_COLS}, 'active' AS listing_status, _day, 0 AS _ord FROM bd
  UNION ALL
  SELECT {SNAP_COLS}, 'likely_removed', _day + 3, 1 FROM bd WHERE (_next IS NULL OR _next > _day + 3) AND _day + 3 <= {e})""",
            """bk AS (
  SELECT * FROM (SELECT *, lag(price) OVER w AS _pv, lag(listing_status) OVER w AS _ps, row_number() OVER w AS _rn
                 FROM bev WINDOW w AS (PARTITION BY listing_id ORDER BY _day, _ord))
  WHERE _rn = 1 OR NOT (price IS NOT DISTINCT FROM _pv AND listing_status IS NOT DISTINCT FROM _ps))""",
            f"""hist AS (
  SELECT {SNAP_COLS}, listing_status, _day AS dbt_valid_from,
         lead(_day) OVER (PARTITION BY listing_id ORDER BY _day) AS dbt_valid_to FROM bk)"""]


def chk_counts() -> str:
    """The check suite as one UNION ALL of (check, model, column, severity, failures)."""
    def row(name, model, col, sev, failing_sql):
        c = "NULL" if col is None else f"'{col}'"
        return (f"SELECT '{name}' AS check_name, '{model}' AS model, CAST({c} AS VARCHAR) AS column_name, "
                f"'{sev}' AS severity, (SELECT count(*) FROM ({failing_sql}) x) AS failures")

    def uniq(t, c):
        return f"SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1"

    def nn(t, c):
        return f"SELECT * FROM {t} WHERE {c} IS NULL"

    def rel(t, c, p, pc, where=""):
        w = f" AND ({where})" if where else ""
        return f"SELECT * FROM {t} WHERE {c} IS NOT NULL{w} AND {c} NOT IN (SELECT {pc} FROM {p} WHERE {pc} IS NOT NULL)"

    def all_of(kind, t, cols, sql, model=None):
        return [row(kind, model or t, c, "error", sql(t, c)) for c in cols.split()]

    box = "bbox_lat_min bbox_lat_max bbox_lon_min bbox_lon_max"
    rows = all_of("not_null", "raw", "id source_city", nn)
    rows += all_of("unique", "lookup", "source_city", uniq, "city_lookup")
    rows += all_of("not_null", "lookup", "source_city city_name voivodeship is_mvp " + box, nn, "city_lookup")
    rows += [row("expression_is_true", "city_lookup", None, "error",
                 "SELECT * FROM lookup WHERE NOT coalesce(bbox_lat_min < bbox_lat_max AND bbox_lon_min < bbox_lon_max, false)")]
    rows += all_of("unique", "stg", "listing_key listing_id", uniq, "stg_listings")
    rows += all_of("not_null", "stg", "listing_key listing_id city price area_sqm", nn, "stg_listings")
    rows += [row("relationships", "stg_listings", "city", "error", rel("stg", "city", "lookup", "city_name")),
             row("accepted_values", "stg_listings", "market_type", "warn",
                 "SELECT market_type FROM stg WHERE market_type NOT IN ('primary', 'secondary') GROUP BY market_type")]
    rows += all_of("not_null", "daily", "listing_id date_collected price area_sqm", nn, "int_listings_daily")
    for t, cols in (("dim_city", "city_key city voivodeship is_mvp"), ("dim_district", "district_key city district"),
                    ("dim_building_type", "building_type_key"), ("dim_market", "market_key"), ("dim_date", "date_key date_day")):
        rows += all_of("unique", t, cols if t == "dim_date" else cols.split()[0], uniq) + all_of("not_null", t, cols, nn)
    rows += all_of("unique", "fact", "listing_key", uniq, "fact_apartments")
    rows += all_of("not_null", "fact", "listing_key city_key district_key building_type_key market_key date_collected_key price area_sqm", nn, "fact_apartments")
    for c, t in (("city_key", "dim_city"), ("district_key", "dim_district"), ("building_type_key", "dim_building_type"), ("market_key", "dim_market")):
        rows.append(row("relationships", "fact_apartments", c, "error", rel("fact", c, t, c)))
    for c in ("date_collected_key", "date_published_key"):
        rows.append(row("relationships", "fact_apartments", c, "error", rel("fact", c, "dim_date", "date_key")))
    rows += all_of("not_null", "price_statistics", "total_listings avg_price", nn, "mart_price_statistics")
    rows += all_of("unique", "city_summary", "city", uniq, "mart_city_summary") + all_of("not_null", "city_summary", "city num_listings", nn, "mart_city_summary")
    rows += [row("relationships", "mart_city_summary", "city", "error", rel("city_summary", "city", "lookup", "city_name"))]
    rows += all_of("not_null", "district_summary", "city district rank_most_expensive rank_cheapest", nn, "mart_district_summary")
    rows += all_of("not_null", "trends", "period_type period_start avg_price num_listings", nn, "mart_market_trends")
    rows += [
        row("unique_combination", "mart_district_summary", None, "error",
            "SELECT city, district FROM district_summary GROUP BY city, district HAVING count(*) > 1"),
        row("accepted_values", "mart_market_trends", "period_type", "error",
            "SELECT period_type FROM trends WHERE period_type NOT IN ('day', 'week', 'month') GROUP BY period_type"),
        row("unique_combination", "mart_market_trends", None, "error",
            "SELECT period_type, period_start FROM trends GROUP BY period_type, period_start HAVING count(*) > 1"),
        row("assert_price_within_bounds", "stg_listings", None, "error", "SELECT * FROM stg WHERE price IS NULL OR price <= 0 OR price > 20000000"),
        row("assert_area_within_bounds", "stg_listings", None, "error", "SELECT * FROM stg WHERE area_sqm IS NULL OR area_sqm < 10 OR area_sqm > 500"),
        row("assert_price_per_sqm_consistent", "stg_listings", None, "error", "SELECT * FROM chk_ppsm"),
        row("assert_geo_within_city_bounds", "stg_listings", None, "error", "SELECT * FROM chk_geo"),
        row("assert_mart_city_summary_reconciles", "mart_city_summary", None, "error", "SELECT * FROM chk_reconcile"),
    ]
    return "\nUNION ALL\n".join(rows)


CHK_PRICE = """chk_price AS (SELECT listing_id, price FROM (SELECT listing_id, price * area_sqm AS price FROM renamed)
  WHERE price IS NULL OR price <= 0 OR price > 20000000)"""
CHK_AREA = "chk_area AS (SELECT listing_id, area_sqm FROM renamed WHERE area_sqm IS NULL OR area_sqm < 10 OR area_sqm > 500)"
SPARSE = [GEO, LOOKUP, EV, RAW.replace("SELECT user_id AS id,", "SELECT user_id * 1000 + k AS id,"), RENAMED, FILTERED, STG]
CHK_PPSM = f"""chk_ppsm AS (
  SELECT listing_id, price, area_sqm, price_per_sqm_listed, {r2('price / nullif(area_sqm, 0)')} AS price_per_sqm_calculated
  FROM stg WHERE price_per_sqm_listed IS NOT NULL AND area_sqm IS NOT NULL AND area_sqm <> 0
    AND abs(price / area_sqm - price_per_sqm_listed) / nullif(price_per_sqm_listed, 0) > 0.05::DOUBLE)"""
CHK_GEO = """chk_geo AS (
  SELECT s.listing_id, s.city, s.latitude, s.longitude FROM stg s JOIN lookup l ON s.city = l.city_name
  WHERE s.latitude IS NOT NULL AND s.longitude IS NOT NULL
    AND (s.latitude < l.bbox_lat_min OR s.latitude > l.bbox_lat_max OR s.longitude < l.bbox_lon_min
         OR s.longitude > l.bbox_lon_max))"""
CITY_SUMMARY_CTE = "city_summary AS (" + CITY_SUMMARY + ")"
DISTRICT_SUMMARY_CTE = "district_summary AS (" + DISTRICT_SUMMARY + ")"
CHK_RECONCILE = """chk_reconcile AS (
  SELECT m.mart_count, s.stg_count
  FROM (SELECT CAST(sum(num_listings) AS BIGINT) AS mart_count FROM city_summary) m,
       (SELECT count(*) AS stg_count FROM stg) s
  WHERE m.mart_count IS DISTINCT FROM s.stg_count)"""

STAR = BASE + [FACT, DIM_CITY, DIM_DISTRICT, DIM_BUILDING, DIM_MARKET]


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["dim_date"] = with_ctes([DIM_DATE], "SELECT * FROM dim_date")
    inc = SPARSE + _target_ctes() + [SLICE, FACT_S]
    q["fact_full_refresh"] = with_ctes(SPARSE + [FACT], "SELECT * FROM fact")
    q["fact_incremental_slice"] = with_ctes(inc, "SELECT * FROM slice")
    q["fact_merge"] = with_ctes(inc, _merge("url"))
    q["fact_schema_sync"] = with_ctes(inc, _merge("CAST(NULL AS VARCHAR) AS url"))

    snap = f"""SELECT {SNAP_COLS}, CASE WHEN CAST(date_collected AS DATE) >= DATE '{params.AS_OF.isoformat()}' - 2
               THEN 'active' ELSE 'likely_removed' END AS listing_status FROM stg"""
    q["snap_status"] = with_ctes(BASE, snap)
    q["snap_scd2_history"] = with_ctes(BASE[:6] + backfill(params.AS_OF), "SELECT * FROM hist")
    q["snap_scd2_apply"] = q["snap_scd2_history"]
    q["report_listing_history"] = with_ctes(
        BASE[:6] + backfill(params.AS_OF),
        f"SELECT listing_id, price, listing_status, dbt_valid_from, dbt_valid_to FROM hist "
        f"WHERE listing_id = {params.HISTORY_LISTING_ID}")

    days = ", ".join(f"DATE '{x.isoformat()}'" for x in params.SNAPSHOT_DAYS)
    q["snap_scd2_partitioned"] = with_ctes(SPARSE[:6] + [f"""st AS (
  SELECT d.day, f.* FROM filtered f JOIN (SELECT unnest([{days}]) AS day) d ON CAST(f.date_collected AS DATE) <= d.day
  QUALIFY row_number() OVER (PARTITION BY d.day, f.listing_id ORDER BY f.date_collected DESC) = 1)""", f"""ch AS (
  SELECT *, lag(price) OVER w AS pv, lag(listing_status) OVER w AS ps, row_number() OVER w AS rn
  FROM (SELECT day, {SNAP_COLS}, CASE WHEN CAST(date_collected AS DATE) >= day - 2 THEN 'active' ELSE 'likely_removed' END AS listing_status FROM st)
  WINDOW w AS (PARTITION BY listing_id ORDER BY day))"""], f"""SELECT {SNAP_COLS}, listing_status, day AS dbt_valid_from,
  lead(day) OVER (PARTITION BY listing_id ORDER BY day) AS dbt_valid_to FROM ch
  WHERE rn = 1 OR NOT (price IS NOT DISTINCT FROM pv AND listing_status IS NOT DISTINCT FROM ps)""")

    q["chk_unique"] = with_ctes(BASE[:4], "SELECT id AS unique_field, count(*) AS n_records FROM raw "
                                          "WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1")
    q["chk_not_null"] = with_ctes(STAR, "SELECT * FROM dim_city WHERE voivodeship IS NULL")
    q["chk_relationships"] = with_ctes(BASE, "SELECT listing_id, city FROM stg WHERE city IS NOT NULL AND city NOT IN "
                                             "(SELECT city_name FROM lookup WHERE city_name IS NOT NULL)")
    q["chk_accepted_values"] = with_ctes(BASE, "SELECT market_type AS value_field, count(*) AS n_records FROM stg "
                                               "WHERE market_type NOT IN ('primary', 'secondary') GROUP BY market_type")
    q["chk_expression"] = with_ctes(BASE[:4], "SELECT * FROM raw WHERE NOT coalesce(price_per_sqm_listed * area_sqm <= price * 1.1::DOUBLE, false)")
    q["chk_unique_combo"] = with_ctes(STAR + [DISTRICT_AGG, DISTRICT_SUMMARY_CTE],
                                      "SELECT city, district, count(*) AS n_records FROM district_summary "
                                      "GROUP BY city, district HAVING count(*) > 1")
    q["chk_fk_where"] = with_ctes(SPARSE + [FACT, DIM_DATE], "SELECT listing_id, date_published_key FROM fact "
                                                             "WHERE date_published_key IS NOT NULL AND date_published_key NOT IN "
                                                             f"(SELECT date_key FROM dim_date WHERE date_day >= DATE '{params.SPINE_FROM.isoformat()}')")
    q["chk_price_bounds"] = with_ctes(BASE[:5] + [CHK_PRICE], "SELECT * FROM chk_price")
    q["chk_area_bounds"] = with_ctes(BASE[:5] + [CHK_AREA], "SELECT * FROM chk_area")
    q["chk_ppsm"] = with_ctes(BASE + [CHK_PPSM], "SELECT * FROM chk_ppsm")
    q["chk_geo"] = with_ctes(BASE + [CHK_GEO], "SELECT * FROM chk_geo")
    q["chk_reconcile"] = with_ctes(SPARSE + _target_ctes(), "SELECT mart_count, stg_count FROM (SELECT count(*) AS mart_count FROM fact_t), "
                                   "(SELECT count(*) AS stg_count FROM stg) WHERE mart_count <> stg_count")
    all_ctes = STAR + [DAILY, TRENDS, DIM_DATE, CITY_SUMMARY_CTE, DISTRICT_AGG, DISTRICT_SUMMARY_CTE,
                       "price_statistics AS (" + PRICE_STATS + ")", CHK_PPSM, CHK_GEO, CHK_RECONCILE]
    q["chk_summary"] = with_ctes(all_ctes, "SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' "
                                           "THEN 'warn' ELSE 'fail' END AS status FROM (" + chk_counts() + ") u")

    q["report_top_districts"] = with_ctes(STAR + [DISTRICT_AGG, DISTRICT_SUMMARY_CTE],
                                          "SELECT city, district, avg_price_per_sqm, rank_most_expensive "
                                          "FROM district_summary WHERE district <> 'Unknown' "
                                          "ORDER BY rank_most_expensive, city, district LIMIT 10")
    q["report_trend_month"] = with_ctes(BASE[:4] + [DAILY, TRENDS], "SELECT period_start, avg_price, price_change_pct "
                                                                    "FROM trends WHERE period_type = 'month'")
    q["report_region_rollup"] = with_ctes(STAR, f"""SELECT c.voivodeship, count(*) AS num_listings,
        {r2('avg(f.price_per_sqm_calculated)')} AS avg_price_per_sqm
        FROM fact f JOIN dim_city c ON f.city_key = c.city_key GROUP BY c.voivodeship""")
    q["report_kpi"] = with_ctes(STAR + ["ps AS (" + PRICE_STATS + ")"],
                                "SELECT avg_price, avg_price_per_sqm, median_price, total_listings FROM ps")
    q["report_daily_volume"] = with_ctes(STAR + [DIM_DATE], f"""SELECT d.date_day, {r2('avg(f.price)')} AS avg_price,
        count(*) AS num_listings FROM fact f JOIN dim_date d ON f.date_collected_key = d.date_key GROUP BY d.date_day""")
    q["report_market_compare"] = with_ctes(STAR, f"""SELECT m.market_type, count(*) AS num_listings,
        {r2('avg(f.price)')} AS avg_price, {r2('avg(f.price_per_sqm_calculated)')} AS avg_price_per_sqm
        FROM fact f JOIN dim_market m ON f.market_key = m.market_key GROUP BY m.market_type""")
    q["report_top_cities"] = with_ctes(STAR + [CITY_SUMMARY_CTE], "SELECT city, avg_price, num_listings "
                                                                  "FROM city_summary ORDER BY avg_price DESC, city LIMIT 10")
    q["report_dual_series"] = with_ctes(STAR, f"""SELECT date_collected_key, {r2('avg(price)')} AS avg_price,
        {r2('avg(price_per_sqm_calculated)')} AS avg_price_per_sqm FROM fact GROUP BY date_collected_key""")
    q["report_map_points"] = with_ctes(STAR, """SELECT f.listing_id, c.city, f.latitude, f.longitude, f.price
        FROM fact f JOIN dim_city c ON f.city_key = c.city_key
        WHERE f.latitude IS NOT NULL AND f.longitude IS NOT NULL""")
    return q
