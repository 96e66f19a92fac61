"""Bucketed tables: which files an upsert touches, schema changes, lost jobs; the incremental load reads new days only."""
import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from estatelens.plans import incremental, staging, star
from estatelens.sources import adapters as A
from estatelens.sources import batches as B
from estatelens.sources.buckets import BucketTable

from .conftest import SF_SMALL


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/data/_bucket=*/*.parquet")}


def rows(df):
    return sorted(map(str, (r.asDict() for r in df.collect())))


def test_upsert_of_one_key_leaves_other_buckets_alone(spark, tmpdir_path):
    t = BucketTable(spark, tmpdir_path + "/t", "k", buckets=8)
    assert t.read() is None and t.rows_of(spark.range(1).toDF("k")) is None
    t.upsert(spark.range(200).select(F.col("id").alias("k"), F.lit(0).alias("v")))
    before = files(t.path)
    assert len({f.split("_bucket=")[1].split("/")[0] for f in before}) == 8
    touched = t.upsert(spark.createDataFrame([(7, 1)], "k long, v int"))
    after = files(t.path)
    assert len(touched) == 1
    same = {f for f in before if f"_bucket={touched[0]}/" not in f}
    assert {f: after[f] for f in same} == {f: before[f] for f in same}
    assert not {f for f in before if f"_bucket={touched[0]}/" in f} & set(after)
    got = {r["k"]: r["v"] for r in t.read().collect()}
    assert got == {k: int(k == 7) for k in range(200)}
    assert [r["v"] for r in t.rows_of(spark.createDataFrame([(7,), (900,)], "k long")).collect()] == [1]
    assert t.upsert(spark.createDataFrame([], "k long, v int")) == [] and files(t.path) == after


def test_columns_follow_the_changes(spark, tmpdir_path):
    t = BucketTable(spark, tmpdir_path + "/t", "k", buckets=4)
    t.replace(spark.range(20).select(F.col("id").alias("k"), F.lit("old").alias("gone")))
    before = files(t.path)
    t.upsert(spark.createDataFrame([(3, "u3"), (99, "u99")], "k long, url string"))
    assert t.read().columns == ["k", "url"]
    assert {r["k"]: r["url"] for r in t.read().collect()} == {k: None for k in range(20)} | {3: "u3", 99: "u99"}
    assert set(before) & set(files(t.path))  # untouched buckets were not rewritten for it


@pytest.mark.parametrize("step", ["_commit", "_note", "_apply"])
def test_a_lost_job_leaves_a_whole_table(spark, tmpdir_path, monkeypatch, step):
    t = BucketTable(spark, tmpdir_path + "/t", "k", buckets=4)
    t.replace(spark.range(50).select(F.col("id").alias("k"), F.lit(0).alias("v")))
    change = spark.createDataFrame([(k, 1) for k in range(0, 60, 3)], "k long, v int")

    def lost(*a, **k):
        raise RuntimeError("lost")

    monkeypatch.setattr(t, step, lost)
    with pytest.raises(RuntimeError):
        t.upsert(change)
    again = BucketTable(spark, t.path, "k", buckets=4)
    old, new = {k: 0 for k in range(50)}, {k: 0 for k in range(50)} | {k: 1 for k in range(0, 60, 3)}
    assert {r["k"]: r["v"] for r in again.read().collect()} == (new if step == "_apply" else old)
    again.upsert(change)
    assert {r["k"]: r["v"] for r in again.read().collect()} == new


def test_incremental_load_reads_new_days_only(spark, tmpdir_path):
    raw, lk = A.raw_sparse_from_events(spark, SF_SMALL), A.lookup_from_nations(spark, SF_SMALL)
    path, cut = tmpdir_path + "/raw", dt.datetime(2024, 1, 20)
    old, new = raw.filter(F.col("date_collected") < F.lit(cut)), raw.filter(F.col("date_collected") >= F.lit(cut))
    target = BucketTable(spark, tmpdir_path + "/fact", "listing_key", buckets=4)
    state = BucketTable(spark, tmpdir_path + "/state", "listing_id", buckets=4)
    B.append_raw(old, path)
    incremental.load_fact(spark, path, lk, target)
    incremental.load_state(spark, path, lk, state, dt.date(2024, 1, 1))
    first = {r["listing_id"]: r["date_collected_key"] for r in target.read().collect()}
    since = incremental.first_day(target.read())
    plan = incremental.changed_listings(spark, path, lk, since)._jdf.queryExecution().executedPlan().toString()
    assert since == dt.date(2024, 1, 19) and "PartitionFilters: [isnotnull(collected_date" in plan
    B.append_raw(new, path)
    incremental.load_fact(spark, path, lk, target)
    incremental.load_state(spark, path, lk, state, dt.date(2024, 1, 20))
    full = staging.stg_listings(B.read_raw(spark, path), lk)
    assert rows(target.read()) == rows(star.fact(full)) and rows(state.read().select(*full.columns)) == rows(full)
    got = {r["listing_id"]: r["date_collected_key"] for r in target.read().collect()}
    kept = {k for k in first if got[k] == first[k] and got[k] < 20240119}
    replaced = {k for k in first if got[k] != first[k]}
    assert kept and replaced and set(got) - set(first)


def test_late_batches_need_a_lookback(spark, tmpdir_path):
    lk = A.lookup_from_nations(spark, SF_SMALL)
    some = A.raw_sparse_from_events(spark, SF_SMALL).filter(F.col("price").between(1, 20_000_000) & F.col("area_sqm").between(10, 500)).limit(3)
    some = spark.createDataFrame(some.collect(), some.schema)
    on = lambda day, k: some.filter(F.col("id") == some.collect()[k]["id"]).withColumn("date_collected", F.lit(dt.datetime(2024, 2, day, 8)))
    path = tmpdir_path + "/raw"
    target = BucketTable(spark, tmpdir_path + "/fact", "listing_key", buckets=2)
    B.append_raw(on(10, 0), path)
    incremental.load_fact(spark, path, lk, target)
    B.append_raw(on(8, 1), path)
    incremental.load_fact(spark, path, lk, target)
    assert target.read().count() == 1
    incremental.load_fact(spark, path, lk, target, lookback_days=2)
    assert target.read().count() == 2
    incremental.load_fact(spark, path, None, target, full_refresh=True)  # without a seed: cities by their slug
    assert target.read().count() == 2
