"""Daily runs: overlapping listings on a second day, a run that dies after the raw append, items, no seed."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from estatelens.operators import normalize, quality, scd2
from estatelens.plans import incremental, pipeline, staging, star
from estatelens.sources import adapters as A
from estatelens.sources import batches as B
from estatelens.sources.tables import TableStore

from .conftest import SF_SMALL


def same(a, b):
    cols = sorted(b.columns)
    return a.select(*cols).exceptAll(b.select(*cols)).count() == 0 and b.select(*cols).exceptAll(a.select(*cols)).count() == 0


def fact_of(store):
    return store.bucketed("fact_apartments", "listing_key").read()


def test_two_daily_runs_with_a_lost_one_between(spark, tmpdir_path, monkeypatch):
    store = TableStore(spark, tmpdir_path + "/wh")
    lk = A.lookup_from_nations(spark, SF_SMALL)
    gb = A.gate_batches_from_events(spark, SF_SMALL)
    cities = [r["source_city"] for r in gb.select("source_city").distinct().orderBy("source_city").collect()]
    half = cities[: len(cities) // 2]
    r1 = pipeline.run_daily(spark, gb, dt.date(2024, 1, 30), store, lk, cities=half, collected_at="2024-01-30 03:00:00")
    first = {r["listing_key"]: r["price"] for r in fact_of(store).collect()}
    # day two delivers all cities, so half of the listings again, some at another price
    second = gb.withColumn("price", F.when(F.col("seq") % 4 == 0, F.col("price") * 1.01).otherwise(F.col("price")))

    def lost(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(incremental, "load_state", lost)
        with pytest.raises(RuntimeError):
            pipeline.run_daily(spark, second, dt.date(2024, 1, 31), store, lk, collected_at="2024-01-31 03:00:00")
    appended = B.read_raw(spark, store.root + "/raw_listings").count()
    r2 = pipeline.run_daily(spark, second, dt.date(2024, 1, 31), store, lk, collected_at="2024-01-31 03:00:00")
    raw = B.read_raw(spark, store.root + "/raw_listings")
    assert raw.count() == appended  # the rerun appended nothing twice
    assert r1.batches_total == len(half) and r2.batches_total == len(cities)
    # cities without a seed row fail tests: the run says so
    assert r1.checks_failed > 0 and r1.run_failed and r2.run_failed
    # the merged fact equals a full rebuild over the raw table the runs appended
    assert same(fact_of(store), star.fact(staging.stg_listings(raw, lk)))
    now = {r["listing_key"]: r["price"] for r in fact_of(store).collect()}
    assert any(now[k] != first[k] for k in first) and set(now) - set(first)
    snap = scd2.History(store, "snapshots_listings").read()
    assert snap.filter(F.col("dbt_valid_to").isNull()).groupBy("listing_key").count().filter("count > 1").count() == 0
    assert snap.filter(F.col("dbt_valid_to") == F.lit(dt.date(2024, 1, 31))).count() > 0
    assert store.read("check_results").count() == 79
    # rejected rows lie as JSON with their own types beside the table of this run
    rejected = spark.read.json(store.root + "/quarantine_json")
    assert rejected.count() >= store.read("quarantine").count() > 0 and dict(rejected.dtypes)["floor"] == "bigint"
    # samples of unexpected values are in the report
    assert store.read("dq_report").filter("unexpected_count > 0 and sample_values <> ''").count() > 0


def test_rows_that_a_lost_append_left_are_not_appended_again(spark, tmpdir_path):
    rows = A.raw_from_events(spark, SF_SMALL).limit(20).cache()
    some = spark.createDataFrame(rows.collect()[:7], rows.schema)
    B.append_raw(some, tmpdir_path + "/raw")
    left = B.missing_rows(rows, tmpdir_path + "/raw")
    assert left.count() == 20 - rows.join(some, ["source_city", "id", "date_collected"], "left_semi").count()


def test_items_run_without_a_seed(spark, tmpdir_path):
    """The job from landed item lines: skipped items are counted, the geo rule and the seed's tests are left out."""
    items = A.items_from_events(spark, SF_SMALL)
    (items.select("source_city", "batch_date", "item_json").coalesce(2).sortWithinPartitions("source_city")
     .write.partitionBy("source_city", "batch_date").text(tmpdir_path + "/items"))
    landed = B.read_items(spark, tmpdir_path + "/items", day="2024-01-31")
    assert landed.count() == items.count()
    store = TableStore(spark, tmpdir_path + "/wh")
    res = pipeline.run_daily_items(spark, landed, dt.date(2024, 1, 31), store, None, collected_at="2024-01-31 03:00:00")
    counts = store.read("normalize_report").agg(F.sum("items"), F.sum("malformed")).first()
    assert counts[0] == items.count() and counts[1] == items.filter("seq % 31 = 0").count() > 0
    gate = quality.gate(normalize.normalize(items, "2024-01-31 03:00:00"))
    raw = B.read_raw(spark, store.root + "/raw_listings")
    assert raw.count() == gate.clean.count() and res.batches_blocked == gate.verdict.filter("systemic_failure").count()
    assert same(fact_of(store), star.fact(staging.stg_listings(raw, None)))
    assert store.read("dq_report").filter("rule_kind = 'geo'").count() == 0
    results = store.read("check_results")
    assert results.filter("model = 'city_lookup' or check_name = 'assert_geo_within_city_bounds'").count() == 0
    assert res.run_failed == (res.checks_failed > 0 or res.batches_blocked == res.batches_total)
