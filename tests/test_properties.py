"""Properties: merge idempotence, incremental replay = full rebuild, late data, SCD2 replay = backfill,
dimensions cover the fact."""

import datetime as dt

from pyspark.sql import functions as F

from estatelens.operators import checks, scd2
from estatelens.operators.merge import merge_by_key
from estatelens.plans import staging, star
from estatelens.sources import adapters as A

from .conftest import SF_SMALL

TIEBREAK = ["l_linenumber", "l_partkey", "l_suppkey"]


def same(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    return a.select(*cols).exceptAll(b.select(*cols)).count() == 0 and \
        b.select(*cols).exceptAll(a.select(*cols)).count() == 0


def li(spark):
    return A.raw_from_lineitem(spark, SF_SMALL), A.lookup_from_nations(spark, SF_SMALL)


def upto(raw, day):
    return raw.filter(F.col("date_collected") < F.lit(day).cast("timestamp_ntz"))


def test_merge_is_idempotent(spark):
    raw, lk = li(spark)
    target = star.fact(staging.stg_listings(upto(raw, "1997-01-01"), lk, TIEBREAK))
    src = star.fact(staging.stg_listings(raw, lk, TIEBREAK)).filter(F.col("listing_id") % 3 == 0)
    once = merge_by_key(target, src, ["listing_key"])
    assert same(once, merge_by_key(once, src, ["listing_key"]))


def test_incremental_replay_equals_full_rebuild(spark):
    raw, lk = li(spark)
    fact = None
    for day in ["1996-01-01", "1997-06-01", "1999-01-01", "2002-01-01"]:
        stg = staging.stg_listings(upto(raw, day), lk, TIEBREAK)
        fact = star.incremental_fact(stg, fact).checkpoint()  # cut lineage between runs
    full = star.fact(staging.stg_listings(raw, lk, TIEBREAK))
    assert same(fact, full)


def test_late_batch_lost_by_default_recovered_with_lookback(spark):
    raw, lk = li(spark)
    early = raw.filter(F.col("date_collected") < F.lit("1998-01-01").cast("timestamp_ntz"))
    late_day = F.lit("1997-06-01").cast("timestamp_ntz")
    on_time = early.filter((F.col("date_collected") < late_day) | (F.col("l_linenumber") != 1))
    target = star.fact(staging.stg_listings(on_time, lk, TIEBREAK)).checkpoint()
    # the lines numbered 1 shipped after June 1997 arrive late, after the target's watermark
    stg_all = staging.stg_listings(early, lk, TIEBREAK)
    full = star.fact(stg_all)
    default = star.incremental_fact(stg_all, target)
    lookback = star.incremental_fact(stg_all, target, lookback_days=400)
    assert not same(default, full)
    assert same(lookback, full)


def test_scd2_daily_apply_equals_backfill(spark):
    raw = A.raw_from_events(spark, SF_SMALL)
    lk = A.lookup_from_nations(spark, SF_SMALL)
    days = [dt.date(2024, 1, d) for d in range(1, 8)]
    hist = None
    for day in days:
        upto_day = raw.filter(F.to_date("date_collected") <= F.lit(day))
        current = scd2.snapshot_source(staging.stg_listings(upto_day, lk), day)
        hist = scd2.scd2_apply(hist, current, day).checkpoint()
    daily = staging.stg_daily(raw, lk)
    extra = [c for c in scd2.SNAPSHOT_COLUMNS if c not in ("listing_id", "price", "listing_status")]
    back = scd2.scd2_backfill(daily, days[-1], extra=extra)
    assert same(hist, back)


def test_dimensions_cover_fact(spark):
    raw = A.raw_from_events(spark, SF_SMALL)
    lk = A.lookup_from_nations(spark, SF_SMALL)
    stg = staging.stg_listings(raw, lk)
    f = star.fact(stg)
    for key, dim in [("city_key", star.dim_city(stg, lk)), ("district_key", star.dim_district(stg)),
                     ("building_type_key", star.dim_building_type(stg)), ("market_key", star.dim_market(stg))]:
        assert checks.relationships(f, key, dim, key).count() == 0
        assert checks.unique(dim, key).count() == 0
