"""Versioned tables survive a lost switch; only a missing path means empty; ties and clock changes have one answer."""
import datetime
import os

import pytest
from pyspark.sql import functions as F

from estatelens.functions import to_utc_wallclock
from estatelens.sources.tables import CommitConflict, TableStore, materialize


def test_unfinished_write_keeps_the_version_before(spark, tmpdir_path):
    store = TableStore(spark, tmpdir_path)
    assert store.read("t") is None
    store.write("t", spark.range(3))
    spark.range(9).write.parquet(f"{tmpdir_path}/t/v-000000000002-0000000f")  # no commit follows
    assert TableStore(spark, tmpdir_path).read("t").count() == 3
    store.write("t", spark.range(5))
    assert TableStore(spark, tmpdir_path).read("t").count() == 5


def test_versions_without_commit_raise(spark, tmpdir_path):
    spark.range(3).write.parquet(f"{tmpdir_path}/t/v-1-a")
    with pytest.raises(RuntimeError):
        TableStore(spark, tmpdir_path).read("t")


def test_of_two_writers_on_one_version_one_wins(spark, tmpdir_path):
    store = TableStore(spark, tmpdir_path)
    store.write("t", spark.range(3))
    seen = store.version("t")
    store.write("t", spark.range(4), base=seen)
    with pytest.raises(CommitConflict):
        TableStore(spark, tmpdir_path).write("t", spark.range(7), base=seen)
    assert store.version("t") == 2 and store.read("t").count() == 4
    store.write("t", spark.range(5))
    assert store.version("t") == 3 and store.read("t").count() == 5


def test_vacuum_keeps_the_newest_and_running_writes(spark, tmpdir_path):
    store = TableStore(spark, tmpdir_path)
    assert store.vacuum("t") == []
    old, lost = store.write("t", spark.range(1)), f"{tmpdir_path}/t/v-000000000002-0000000f"
    spark.range(9).write.parquet(lost)
    running = f"{tmpdir_path}/t/v-000000000004-0000000e"  # another writer's next version, not committed yet
    spark.range(9).write.parquet(running)
    kept = [store.write("t", spark.range(n)) for n in (2, 3)]
    before = store.read("t")
    assert store.vacuum("t") == sorted(p.rsplit("/", 1)[1] for p in (old, lost))
    assert all(os.path.exists(p) for p in [*kept, running]) and not os.path.exists(old) and not os.path.exists(lost)
    assert before.count() == 3 and store.read("t").count() == 3
    with pytest.raises(CommitConflict):  # the number stays taken though its data are gone
        store.write("t", spark.range(8), base=0)
    with pytest.raises(ValueError):
        store.vacuum("t", 0)


def test_store_that_retains(spark, tmpdir_path):
    store = TableStore(spark, tmpdir_path, retain=2)
    for n in range(1, 5):
        before = store.read("t")
        store.write("t", spark.range(n) if before is None else before.union(spark.range(1)))
    assert len([v for v in os.listdir(f"{tmpdir_path}/t") if v.startswith("v-")]) == 2
    assert store.read("t").count() == 4
    assert materialize(spark.range(6), "table", store, "t").count() == 6
    with pytest.raises(ValueError):
        TableStore(spark, tmpdir_path, retain=1)


def test_utc_across_a_clock_change(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Warsaw")
        got = spark.createDataFrame([("2024-10-27T01:30:00Z",), ("2024-10-27T00:30:00.5Z",)], "s string").select(to_utc_wallclock(F.col("s")).alias("t")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [r["t"] for r in got] == [datetime.datetime(2024, 10, 27, 1, 30), datetime.datetime(2024, 10, 27, 0, 30, 0, 500000)]
