"""Partitioned type-2 history: what each run closes and opens, untouched closed files, runs that die halfway."""
import datetime as dt
import glob
import os

import pytest

from estatelens.operators.scd2 import History
from estatelens.sources.tables import TableStore

SCHEMA = "listing_key string, listing_id long, city string, district string, price double, area_sqm double, market_type string, date_collected timestamp_ntz, listing_status string"
D1, D2, D3 = dt.date(2024, 3, 1), dt.date(2024, 3, 2), dt.date(2024, 3, 3)


def frame(spark, *rows):
    return spark.createDataFrame([(k, 1, "c", None, p, 40.0, None, dt.datetime(2024, 3, 1), s) for k, p, s in rows], SCHEMA)


def versions(h):
    return sorted((r["listing_key"], r["price"], r["listing_status"], r["dbt_valid_from"], r["dbt_valid_to"]) for r in h.read().collect())


def closed_files(h):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{h.closed_path}/**/*.parquet", recursive=True)}


def sorted_rows(rows):
    return sorted(rows, key=lambda r: r[:4])


def test_changes_new_listings_and_status_flips(spark, tmpdir_path):
    h = History(TableStore(spark, tmpdir_path), "snap")
    assert h.read() is None
    h.apply(frame(spark, ("same", 1.0, "active"), ("price", 2.0, "active"), ("quiet", 3.0, "active"), ("gone", 4.0, "active"), ("null", None, "active")), D1)
    h.apply(frame(spark, ("same", 1.0, "active"), ("price", 2.5, "active"), ("quiet", 3.0, "likely_removed"), ("new", 9.0, "active"), ("null", None, "active")), D2)
    day2 = closed_files(h)
    assert day2
    h.apply(frame(spark, ("same", 1.0, "active"), ("price", 2.7, "active"), ("quiet", 3.0, "active"), ("new", 9.0, "active"), ("null", 5.0, "active")), D3)
    assert {f: m for f, m in closed_files(h).items() if f in day2} == day2  # a day's closed versions are never rewritten
    got = sorted_rows((r["listing_key"], r["dbt_valid_from"], r["price"], r["listing_status"], r["dbt_valid_to"]) for r in h.read().collect())
    assert got == sorted_rows([
        ("same", D1, 1.0, "active", None), ("price", D1, 2.0, "active", D2), ("price", D2, 2.5, "active", D3), ("price", D3, 2.7, "active", None),
        ("quiet", D1, 3.0, "active", D2), ("quiet", D2, 3.0, "likely_removed", D3), ("quiet", D3, 3.0, "active", None),
        ("gone", D1, 4.0, "active", None), ("new", D2, 9.0, "active", None), ("null", D1, None, "active", D3), ("null", D3, 5.0, "active", None)])


def test_a_run_that_dies_between_its_writes_can_be_repeated(spark, tmpdir_path, monkeypatch):
    h = History(TableStore(spark, tmpdir_path), "snap")
    h.apply(frame(spark, ("a", 1.0, "active"), ("b", 1.0, "active")), D1)
    before = h.read().collect()

    def lost(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(h.store, "write", lost)
        with pytest.raises(RuntimeError):
            h.apply(frame(spark, ("a", 2.0, "active"), ("b", 1.0, "active")), D2)
    assert sorted(h.read().collect()) == sorted(before)  # what it closed does not count yet
    h.apply(frame(spark, ("a", 2.0, "active"), ("b", 1.0, "active")), D2)
    h.apply(frame(spark, ("a", 2.0, "active"), ("b", 1.0, "active")), D2)  # a rerun of a finished day changes nothing
    h.apply(frame(spark, ("a", 2.0, "active"), ("b", 7.0, "active")), D2)  # a second run of the day with another change
    got = sorted((r["listing_key"], r["price"], str(r["dbt_valid_from"]), str(r["dbt_valid_to"])) for r in h.read().collect())
    assert got == [("a", 1.0, str(D1), str(D2)), ("a", 2.0, str(D2), "None"), ("b", 1.0, str(D1), str(D2)), ("b", 7.0, str(D2), "None")]
