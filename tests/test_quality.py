"""Quality-gate cases on a typed city batch (one city, 14 keys), padded to >= 200 rows.

The base batch is generated by rule with the documented shape of the source's sample: 18 rows, 3 null
districts, every coordinate null, all 'secondary', no null floor, prices 135 000 to 1 075 000.
"""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from estatelens.operators import quality as Q
from estatelens.sources import seeds

BASE_ROWS = 18


def base_rows(n=BASE_ROWS, start_id=1000):
    out = []
    for i in range(n):
        area = 30.0 + 5 * i
        price = 135_000.0 + i * (1_075_000.0 - 135_000.0) / (n - 1)
        out.append(dict(
            id=start_id + i, url=f"https://listings.example/ad/{start_id + i}", city="Katowice",
            district=None if i % 6 == 0 else f"District {i % 4}", price=price, area_sqm=area,
            num_rooms=1 + i % 4, rooms_capped=(i % 4 == 3), floor=i % 9, floor_capped=False,
            market_type="secondary", price_per_sqm_listed=round(price / area, 2), latitude=None, longitude=None,
            seq=i))
    return out


def padded(min_rows=200):
    reps = -(-min_rows // BASE_ROWS)
    rows = []
    for r in range(reps):
        for x in base_rows(start_id=1000 + r * BASE_ROWS):
            x = dict(x)
            x["seq"] = len(rows)
            rows.append(x)
    return rows


SCHEMA = ("id long, url string, city string, district string, price double, area_sqm double, num_rooms long, "
          "rooms_capped boolean, floor long, floor_capped boolean, market_type string, price_per_sqm_listed double, "
          "latitude double, longitude double, seq long")


def frame(spark, rows, city="katowice", schema=SCHEMA):
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", ")) for r in rows], schema)
    return df.withColumn("source_city", F.lit(city).cast("string")).withColumn("batch_date", F.lit(dt.date(2026, 8, 1)))


def run(spark, df, seed=True):
    res = Q.gate(df, seed=seeds.city_lookup(spark) if seed else None)
    v = res.verdict.first()
    failed = {(r["expectation"], r["column"]) for r in res.rule_results.filter("suite = 'critical' AND NOT success").collect()}
    return v["systemic_failure"], failed, res.quarantine.count(), res.clean.count(), res


def test_clean_batch_passes(spark):
    rows = base_rows()
    sysf, failed, q, c, _ = run(spark, frame(spark, rows))
    assert not sysf and not failed and q == 0 and c == len(rows)


def test_single_bad_row_quarantined(spark):
    rows = padded()
    rows[0]["area_sqm"] = 495000.0
    rows[0]["price_per_sqm_listed"] = rows[0]["price"] / 87.0
    sysf, failed, q, c, res = run(spark, frame(spark, rows))
    assert not sysf
    assert (Q.BETWEEN, "area_sqm") in failed
    assert q == 1 and c == len(rows) - 1
    assert res.quarantine.first()["area_sqm"] == 495000.0


def test_widespread_corruption_is_systemic(spark):
    rows = padded()
    n_bad = int(len(rows) * (Q.QUARANTINE_MAX_FRACTION + 0.05))
    for r in rows[:n_bad]:
        r["area_sqm"] = 3.0
    sysf, failed, q, c, _ = run(spark, frame(spark, rows))
    assert sysf and (Q.BETWEEN, "area_sqm") in failed
    assert q == 0 and c == 0  # blocked as a whole: nothing dropped row by row, nothing passes on


@pytest.mark.parametrize("col,value,rule", [
    ("price", -100.0, (Q.BETWEEN, "price")),
    ("url", None, (Q.NOT_NULL, "url")),
    ("price_per_sqm_listed", 500.0, (Q.BETWEEN, Q.GAP)),
    ("rooms_capped", None, (Q.NOT_NULL, "rooms_capped")),
    ("market_type", "unknown", (Q.IN_SET, "market_type")),
])
def test_single_defect_quarantined(spark, col, value, rule):
    rows = padded()
    rows[0][col] = value
    sysf, failed, q, c, _ = run(spark, frame(spark, rows))
    assert not sysf and rule in failed and q == 1 and c == len(rows) - 1


def test_rooms_capped_wrong_type(spark):
    rows = padded()
    for r in rows:
        r["rooms_capped"] = "true" if r["rooms_capped"] else "false"
    rows[0]["rooms_capped"] = "yes"
    schema = SCHEMA.replace("rooms_capped boolean", "rooms_capped string")
    sysf, failed, q, _, _ = run(spark, frame(spark, rows, schema=schema))
    assert not sysf and (Q.IN_SET, "rooms_capped") in failed and q == 1


def test_duplicate_id_flags_every_copy(spark):
    rows = padded()
    rows[1]["id"] = rows[0]["id"]
    sysf, failed, q, c, _ = run(spark, frame(spark, rows))
    assert not sysf and (Q.UNIQUE, "id") in failed
    assert q == 2 and c < len(rows)


def test_rooms_mostly_tolerance(spark):
    rows = padded()
    for r in rows[:5]:  # 5 of 216 out of range: within the 5 % tolerance -> nobody quarantined
        r["num_rooms"] = 50
    sysf, failed, q, _, _ = run(spark, frame(spark, rows))
    assert not sysf and (Q.BETWEEN, "num_rooms") not in failed and q == 0


@pytest.mark.parametrize("null_all", [False, True])
def test_district_never_blocks(spark, null_all):
    rows = base_rows()
    if null_all:
        for r in rows:
            r["district"] = None
    else:
        next(r for r in rows if r["district"] is not None)["district"] = None
    sysf, failed, q, _, res = run(spark, frame(spark, rows))
    assert not sysf and q == 0
    warn = res.rule_results.filter("suite = 'warning' AND column = 'district'").first()
    assert warn["success"] == (not null_all)


GDANSK = (54.3520, 18.6466)
KATOWICE = (50.2649, 19.0238)


@pytest.mark.parametrize("city,coords,expect_q", [
    ("katowice", GDANSK, 1),          # outside the city's box
    ("katowice", KATOWICE, 0),        # inside
    ("katowice", None, 0),            # null coordinates pass
    ("not-a-real-city", GDANSK, 0),   # unknown city: rule skipped
    (None, GDANSK, 0),                # no city: rule skipped
])
def test_geo_box(spark, city, coords, expect_q):
    rows = padded()
    if coords:
        rows[0]["latitude"], rows[0]["longitude"] = coords
    sysf, _, q, _, _ = run(spark, frame(spark, rows, city=city))
    assert not sysf and q == expect_q


def test_missing_geo_columns_skip(spark):
    df = frame(spark, base_rows()).drop("latitude", "longitude")
    sysf, failed, q, _, res = run(spark, df)
    assert not sysf and q == 0
    assert res.rule_results.filter("column = 'latitude'").count() == 0


def test_split_is_a_partition_of_passing_batches(spark):
    rows = padded()
    rows[3]["price"] = -1.0
    df = frame(spark, rows)
    _, _, q, c, res = run(spark, df)
    assert q + c == df.count()
    assert res.clean.join(res.quarantine, ["seq"], "inner").count() == 0


def test_every_rule_judges_values_at_its_bounds_as_written_out(spark):
    """Values on, just inside and just outside each bound: counts of the gate against the twin's own list of rules."""
    import duckdb

    from estatelens.plans.oracle_gate import RULES

    box = seeds.city_lookup(spark).where("source_city = 'katowice'").first()
    lat, lon = (box["bbox_lat_min"], box["bbox_lat_max"]), (box["bbox_lon_min"], box["bbox_lon_max"])
    near = lambda lo, hi, e: [lo - e, lo, lo + e, hi - e, hi, hi + e]
    cells = {"price": near(1.0, 20_000_000.0, 0.5), "area_sqm": near(10.0, 500.0, 0.01), "num_rooms": near(1, 10, 1),
             "latitude": near(*lat, 1e-6), "longitude": near(*lon, 1e-6), "market_type": ["primary", "Primary", "", None],
             "price_per_sqm_listed": [0.0, 0.94, 0.951, 0.96, 1.0, 1.05, 1.06], "rooms_capped": [None, True], "floor_capped": [None, False],
             "id": [None, 1000, 1001], "url": [None, ""], "city": [None], "district": [None]}
    rows = padded()
    changed = [{**rows[5], "seq": 0, "id": 50_000 + 100 * i + j, "price_per_sqm_listed": None, column: v if column != "price_per_sqm_listed" else v * rows[5]["price"] / rows[5]["area_sqm"]}
               for i, (column, values) in enumerate(cells.items()) for j, v in enumerate(values)]
    df = frame(spark, rows + changed)
    got = {(r["suite"], r["expectation"], r["column"]): r["unexpected_count"] for r in Q.gate(df, seed=seeds.city_lookup(spark)).rule_results.collect()}
    typed = Q.with_bounds(Q.ppsm_gap(df), seeds.city_lookup(spark)).toArrow()
    con = duckdb.connect()
    con.register("typed", typed)
    con.execute("CREATE VIEW v AS SELECT *, id IS NOT NULL AND count(*) OVER (PARTITION BY id) > 1 AS _dup_id FROM typed")
    expected = {(r.suite, r.expectation, r.column): con.execute(f"SELECT count(*) FILTER (WHERE {r.bad}) FROM v WHERE {r.applies}").fetchone()[0] for r in RULES}
    assert got == expected
    assert all(expected[r.suite, r.expectation, r.column] for r in RULES if "capped" not in r.column or r.expectation != Q.IN_SET)
