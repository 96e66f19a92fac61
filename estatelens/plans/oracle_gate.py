"""DuckDB twins of the quality-gate queries. The rules are written out here as SQL, apart from the engine's own list, so that
a wrong bound in either shows as a difference."""

from __future__ import annotations

from typing import NamedTuple

from .oracle_sql import EV, GEO, LOOKUP, with_ctes
from .params import SUBSET_CITIES

GB = """gb AS (
  SELECT source_city, DATE '2024-01-31' AS batch_date, event_id AS seq,
    CAST(CASE WHEN event_id % 89 = 0 THEN -(n_nationkey + 1000) ELSE event_id END AS BIGINT) AS id,
    CASE WHEN bad AND kind = 2 THEN NULL ELSE 'https://listings.example/ad/' || CAST(event_id AS VARCHAR) END AS url,
    CASE WHEN bad AND kind = 3 THEN NULL ELSE n_name END AS city,
    CASE WHEN event_id % 5 = 0 OR (n_nationkey % 4 = 0 AND event_id % 2 = 0) THEN NULL ELSE c_mktsegment END AS district,
    CASE WHEN bad AND kind = 0 THEN -100.0::DOUBLE ELSE value + 1 END AS price,
    CASE WHEN bad AND kind = 1 THEN 3.0::DOUBLE ELSE CAST(k + 10 AS DOUBLE) END AS area_sqm,
    CAST(CASE WHEN bad AND kind = 8 THEN 50 ELSE 1 + k % 6 END AS BIGINT) AS num_rooms,
    CASE WHEN bad AND kind = 4 THEN NULL ELSE k % 6 = 5 END AS rooms_capped,
    CAST(k % 13 AS BIGINT) AS floor,
    k % 13 = 11 AS floor_capped,
    CASE WHEN bad AND kind = 5 THEN 'unknown' WHEN event_type = 'purchase' THEN 'primary'
         WHEN event_type = 'signup' THEN NULL ELSE 'secondary' END AS market_type,
    CASE WHEN bad AND kind = 6 THEN 500.0::DOUBLE ELSE (value + 1) / CAST(k + 10 AS DOUBLE) END AS price_per_sqm_listed,
    CASE WHEN bad AND kind = 7 THEN 0.0::DOUBLE WHEN event_id % 7 = 0 THEN NULL
         ELSE 40 + n_nationkey + (event_id % 40) / 100.0::DOUBLE END AS latitude,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE 10 + n_regionkey + (event_id % 25) / 100.0::DOUBLE END AS longitude
  FROM (SELECT *, (event_id % 41 = 0) OR (n_nationkey % 5 = 0 AND event_id % 9 = 0) AS bad,
               (event_id // 7) % 9 AS kind FROM ev) z)"""

GB_COLUMNS = ["source_city", "batch_date", "seq", "id", "url", "city", "district", "price", "area_sqm",
              "num_rooms", "rooms_capped", "floor", "floor_capped", "market_type", "price_per_sqm_listed",
              "latitude", "longitude"]

GAP_SQL = """CASE WHEN price_per_sqm_listed IS NOT NULL AND area_sqm IS NOT NULL AND area_sqm <> 0 THEN
    CASE WHEN price_per_sqm_listed = 0 THEN CASE WHEN abs(price / area_sqm) > 0 THEN 'inf'::DOUBLE END
         ELSE abs(price / area_sqm - price_per_sqm_listed) / price_per_sqm_listed END END"""

GBX = f"""gbx AS (
  SELECT g.*, {GAP_SQL} AS price_per_sqm_diff_pct,
         l.bbox_lat_min, l.bbox_lat_max, l.bbox_lon_min, l.bbox_lon_max,
         coalesce(d.dup, false) AS _dup_id
  FROM gb g
  LEFT JOIN (SELECT * FROM lookup WHERE bbox_lat_min IS NOT NULL AND bbox_lat_max IS NOT NULL
             AND bbox_lon_min IS NOT NULL AND bbox_lon_max IS NOT NULL) l ON g.source_city = l.source_city
  LEFT JOIN (SELECT source_city, batch_date, id, true AS dup FROM gb WHERE id IS NOT NULL
             GROUP BY ALL HAVING count(*) > 1) d
    ON g.source_city = d.source_city AND g.batch_date = d.batch_date AND g.id = d.id)"""


class Rule(NamedTuple):
    """A rule in SQL: ``bad`` marks a row that breaks it, ``counted`` one that it judges, ``applies`` a batch that it is for."""

    suite: str
    expectation: str
    column: str
    kind: str
    mostly: float
    bad: str
    counted: str = "true"
    applies: str = "true"


# The gate's rules and thresholds.
NOT_NULL, UNIQUE = "expect_column_values_to_not_be_null", "expect_column_values_to_be_unique"
BETWEEN, IN_SET = "expect_column_values_to_be_between", "expect_column_values_to_be_in_set"
LAT_BOX = "(bbox_lat_min IS NOT NULL AND bbox_lat_max IS NOT NULL)"
LON_BOX = "(bbox_lon_min IS NOT NULL AND bbox_lon_max IS NOT NULL)"
MAX_QUARANTINED = "0.05::DOUBLE"
SAMPLES = 20
RULES = (
    Rule("critical", NOT_NULL, "id", "not_null", 1.0, "id IS NULL"),
    Rule("critical", UNIQUE, "id", "unique", 1.0, "id IS NOT NULL AND _dup_id", "id IS NOT NULL"),
    Rule("critical", NOT_NULL, "url", "not_null", 1.0, "url IS NULL"),
    Rule("critical", NOT_NULL, "city", "not_null", 1.0, "city IS NULL"),
    Rule("critical", BETWEEN, "price", "between", 1.0, "price < 1 OR price > 20000000", "price IS NOT NULL"),
    Rule("critical", BETWEEN, "area_sqm", "between", 1.0, "area_sqm < 10 OR area_sqm > 500", "area_sqm IS NOT NULL"),
    Rule("critical", BETWEEN, "num_rooms", "mostly", 0.95, "num_rooms < 1 OR num_rooms > 10", "num_rooms IS NOT NULL"),
    Rule("critical", NOT_NULL, "rooms_capped", "not_null", 1.0, "rooms_capped IS NULL"),
    Rule("critical", IN_SET, "rooms_capped", "in_set", 1.0, "rooms_capped NOT IN (true, false)", "rooms_capped IS NOT NULL"),
    Rule("critical", NOT_NULL, "floor_capped", "not_null", 1.0, "floor_capped IS NULL"),
    Rule("critical", IN_SET, "floor_capped", "in_set", 1.0, "floor_capped NOT IN (true, false)", "floor_capped IS NOT NULL"),
    Rule("critical", IN_SET, "market_type", "in_set", 1.0, "market_type NOT IN ('primary', 'secondary')", "market_type IS NOT NULL"),
    Rule("critical", BETWEEN, "price_per_sqm_diff_pct", "cross_field", 1.0, "price_per_sqm_diff_pct < 0 OR price_per_sqm_diff_pct > 0.05::DOUBLE", "price_per_sqm_diff_pct IS NOT NULL"),
    Rule("critical", BETWEEN, "latitude", "geo", 1.0, "latitude < bbox_lat_min OR latitude > bbox_lat_max", f"latitude IS NOT NULL AND {LAT_BOX}", LAT_BOX),
    Rule("critical", BETWEEN, "longitude", "geo", 1.0, "longitude < bbox_lon_min OR longitude > bbox_lon_max", f"longitude IS NOT NULL AND {LON_BOX}", LON_BOX),
    Rule("warning", NOT_NULL, "district", "warning", 0.6, "district IS NULL"),
)


def _rows_cte(rules) -> str:
    cols = []
    for i, r in enumerate(rules):
        cols += [f"coalesce({r.bad}, false) AS b{i}", f"coalesce({r.counted}, false) AS c{i}", f"coalesce({r.applies}, false) AS a{i}"]
    return "rw AS (SELECT *, " + ",\n  ".join(cols) + " FROM gbx)"


def _stats_cte(rules) -> str:
    cols = ["count(*) AS n"]
    for i, _ in enumerate(rules):
        cols += [f"sum(CASE WHEN b{i} THEN 1 ELSE 0 END) AS b{i}", f"sum(CASE WHEN c{i} THEN 1 ELSE 0 END) AS c{i}",
                 f"bool_or(a{i}) AS a{i}"]
    return "st AS (SELECT source_city, batch_date, " + ", ".join(cols) + " FROM rw GROUP BY source_city, batch_date)"


def _results_cte(rules) -> str:
    parts = []
    for i, r in enumerate(rules):
        success = f"(c{i} = 0 OR CAST(c{i} - b{i} AS DOUBLE) / CAST(c{i} AS DOUBLE) >= {float(r.mostly)!r}::DOUBLE)"
        parts.append(
            f"SELECT source_city, batch_date, '{r.suite}' AS suite, '{r.expectation}' AS expectation, '{r.column}' AS \"column\", "
            f"'{r.kind}' AS rule_kind, {i} AS rule_idx, {float(r.mostly)!r}::DOUBLE AS mostly, {success} AS success, "
            f"CAST(b{i} AS BIGINT) AS unexpected_count, "
            f"CASE WHEN c{i} > 0 THEN CAST(b{i} AS DOUBLE) * 100.0::DOUBLE / CAST(c{i} AS DOUBLE) END AS unexpected_percent, "
            f"CAST(n AS BIGINT) AS element_count FROM st WHERE a{i}")
    return "rr AS (" + "\nUNION ALL\n".join(parts) + ")"


def _failed_cte(rules) -> str:
    cols = []
    for i, r in enumerate(rules):
        if r.suite != "critical":
            cols.append(f"false AS f{i}")
        else:
            cols.append(f"coalesce(bool_or(rule_idx = {i} AND NOT success), false) AS f{i}")
    names = ", ".join(
        f"CASE WHEN bool_or(rule_idx = {i} AND NOT success) THEN '{r.expectation}({r.column})' END"
        for i, r in enumerate(rules) if r.suite == "critical")
    return ("fl AS (SELECT source_city, batch_date, " + ", ".join(cols) +
            f", array_to_string(list_sort(list_filter([{names}], lambda x: x IS NOT NULL)), ', ') AS failed_rules"
            " FROM rr GROUP BY source_city, batch_date)")


def _verdict_cte(rules) -> str:
    any_bad = " OR ".join(f"(r.b{i} AND f.f{i})" for i, _ in enumerate(rules))
    return f"""vd AS (
  SELECT r.source_city, r.batch_date, count(*) AS rows,
         sum(CASE WHEN {any_bad} THEN 1 ELSE 0 END) AS quarantined_rows,
         any_value(f.failed_rules) AS failed_rules
  FROM rw r JOIN fl f ON r.source_city = f.source_city AND r.batch_date = f.batch_date
  GROUP BY r.source_city, r.batch_date),
verdict AS (
  SELECT source_city, batch_date, CAST(rows AS BIGINT) AS rows, CAST(quarantined_rows AS BIGINT) AS quarantined_rows,
         CAST(quarantined_rows AS DOUBLE) / CAST(rows AS DOUBLE) AS quarantine_fraction, failed_rules,
         CAST(quarantined_rows AS DOUBLE) / CAST(rows AS DOUBLE) > {MAX_QUARANTINED} AS systemic_failure
  FROM vd),
rowflag AS (
  SELECT r.*, ({any_bad}) AS row_bad, v.systemic_failure
  FROM rw r JOIN fl f ON r.source_city = f.source_city AND r.batch_date = f.batch_date
  JOIN verdict v ON r.source_city = v.source_city AND r.batch_date = v.batch_date)"""


def _sample_cte(rules) -> str:
    parts = []
    for i, r in enumerate(rules):
        v = f"CAST(TRY_CAST({r.column} AS DECIMAL(38,6)) AS VARCHAR)" if r.column in (
            "price", "area_sqm", "price_per_sqm_diff_pct", "latitude", "longitude", "price_per_sqm_listed") else f"CAST({r.column} AS VARCHAR)"
        parts.append(f"SELECT source_city, batch_date, seq, {i} AS rule_idx, coalesce({v}, 'null') AS v FROM rw WHERE b{i}")
    return ("smp AS (SELECT source_city, batch_date, rule_idx, string_agg(v, ', ' ORDER BY seq) AS sample_values FROM ("
            "SELECT * FROM (" + " UNION ALL ".join(parts) + ") u "
            "QUALIFY row_number() OVER (PARTITION BY source_city, batch_date, rule_idx ORDER BY seq) <= "
            f"{SAMPLES}) t GROUP BY source_city, batch_date, rule_idx)")


def ctes(rules=None):
    rules = rules or RULES
    return [GEO, LOOKUP, EV, GB, GBX, _rows_cte(rules), _stats_cte(rules), _results_cte(rules),
            _failed_cte(rules), _verdict_cte(rules)]


RR_COLS = ("source_city, batch_date, suite, expectation, \"column\", rule_kind, mostly, success, unexpected_count, "
           "unexpected_percent, element_count")


def build() -> dict[str, str]:
    c = ctes()
    cols = ", ".join(GB_COLUMNS)
    q = {
        "dq_ppsm_gap": with_ctes([GEO, EV, GB], f"SELECT source_city, batch_date, seq, id, price, area_sqm, "
                                 f"price_per_sqm_listed, {GAP_SQL} AS price_per_sqm_diff_pct FROM gb"),
        "dq_report": with_ctes(c + [_sample_cte(RULES)],
                               "SELECT rr.source_city, rr.batch_date, suite, expectation, \"column\", rule_kind, success, "
                               "unexpected_count, unexpected_percent, element_count, coalesce(smp.sample_values, '') AS sample_values "
                               "FROM rr LEFT JOIN smp ON rr.source_city = smp.source_city AND rr.batch_date = smp.batch_date "
                               "AND rr.rule_idx = smp.rule_idx"),
        "dq_clean_rows": with_ctes(c, f"SELECT {cols} FROM rowflag WHERE NOT systemic_failure AND NOT row_bad"),
        "dq_quarantined_rows": with_ctes(c, f"SELECT {cols} FROM rowflag WHERE NOT systemic_failure AND row_bad"),
        "dq_batch_verdict": with_ctes(c, "SELECT * FROM verdict"),
        "dq_gate": with_ctes(c, """SELECT batch_date, CAST(count(*) AS BIGINT) AS batches,
            CAST(sum(CASE WHEN systemic_failure THEN 0 ELSE 1 END) AS BIGINT) AS passed_batches,
            CAST(sum(CASE WHEN systemic_failure THEN 1 ELSE 0 END) AS BIGINT) AS blocked_batches,
            CAST(sum(CASE WHEN systemic_failure THEN 0 ELSE rows - quarantined_rows END) AS BIGINT) AS clean_rows,
            CAST(sum(CASE WHEN systemic_failure THEN 0 ELSE quarantined_rows END) AS BIGINT) AS quarantined_rows,
            bool_and(systemic_failure) AS run_failed
            FROM verdict GROUP BY batch_date"""),
    }
    for key, tag in [("dq_not_null", "not_null"), ("dq_unique", "unique"), ("dq_between", "between"),
                     ("dq_mostly", "mostly"), ("dq_in_set", "in_set"), ("dq_cross_field", "cross_field"),
                     ("dq_geo_bbox", "geo"), ("dq_warning_rate", "warning")]:
        q[key] = with_ctes(c, f"SELECT {RR_COLS} FROM rr WHERE rule_kind = '{tag}'")
    subset = ", ".join(f"'{s}'" for s in SUBSET_CITIES)
    sub_ctes = [x.replace("FROM ev) z)", f"FROM ev WHERE source_city IN ({subset})) z)") if x.startswith("gb AS") else x
                for x in c]
    q["filter_city_subset"] = with_ctes(sub_ctes, "SELECT * FROM verdict")
    return q

