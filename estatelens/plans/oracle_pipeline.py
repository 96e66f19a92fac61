"""DuckDB twins for the daily job and the streaming load (both must give the full-rebuild fact)."""

from __future__ import annotations

from . import oracle_gate, params
from .oracle_sql import BASE, FACT, FILTERED, RENAMED, STG, with_ctes

CLEAN_RAW = f"""raw AS (
  SELECT id, url, CAST(NULL AS VARCHAR) AS title, CAST(NULL AS VARCHAR) AS created_time,
         TIMESTAMP '{params.COLLECTED_AT}' AS date_collected, city, district, latitude, longitude, price,
         CAST(NULL AS VARCHAR) AS currency, area_sqm, CAST(NULL AS DOUBLE) AS extra_rent_pln, num_rooms,
         rooms_capped, floor, floor_capped, CAST(NULL AS BOOLEAN) AS is_furnished,
         CAST(NULL AS VARCHAR) AS building_type, market_type, price_per_sqm_listed, source_city
  FROM rowflag WHERE NOT systemic_failure AND NOT row_bad)"""


def build() -> dict[str, str]:
    return {
        "pipeline_daily": with_ctes(oracle_gate.ctes() + [CLEAN_RAW, RENAMED, FILTERED, STG, FACT], "SELECT * FROM fact"),
        "fact_stream_incremental": with_ctes(BASE + [FACT], "SELECT * FROM fact"),
    }
