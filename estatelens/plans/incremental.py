"""Loading current state and fact from the days of the raw table that can have changed.

The raw table is partitioned by collection day. A listing whose newest scrape lies on or after a day has all its newer
scrapes in the partitions from that day on, so the newest in-bounds row among these partitions is its newest row of all:
no older partition is opened, and no row of an unchanged listing is read. The rows found are upserted by key into
bucketed tables, so a load costs what the new days hold and the buckets they touch.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ..session import written
from ..sources import batches as B
from ..sources.buckets import BucketTable
from . import staging, star


def day_of(key: int) -> dt.date:
    return dt.date(key // 10000, key // 100 % 100, key % 100)


def first_day(target: DataFrame | None, lookback_days: int = 0) -> dt.date | None:
    """The day to load from: the newest day of the target (same-day reruns are merged again), less a lookback for
    batches that arrive late. None where there is nothing yet."""
    newest = star.watermark(target) if target is not None else 0
    return day_of(newest) - dt.timedelta(days=lookback_days) if newest else None


def changed_listings(spark: SparkSession, raw_path: str, lookup: DataFrame, since: dt.date | None) -> DataFrame:
    """Newest in-bounds row of each listing scraped since a day; the literal day prunes the raw table's partitions."""
    return staging.stg_listings(B.read_raw(spark, raw_path, since=None if since is None else since.isoformat()), lookup)


def load_fact(spark: SparkSession, raw_path: str, lookup: DataFrame, target: BucketTable, full_refresh: bool = False,
              lookback_days: int = 0) -> list[int]:
    """Merge the changed listings into the fact, or build it anew on first use and on a full refresh."""
    since = None if full_refresh else first_day(target.read(), lookback_days)
    rows = star.fact(changed_listings(spark, raw_path, lookup, since))
    if since is None:
        target.replace(rows)
        return []
    return target.upsert(rows)


def load_state(spark: SparkSession, raw_path: str, lookup: DataFrame, target: BucketTable, since: dt.date | None) -> DataFrame:
    """Current state of all listings after scrapes from ``since`` on were appended; late days may lie before the newest."""
    rows = written(changed_listings(spark, raw_path, lookup, since if target.exists() else None), "state-changes")
    if target.exists():
        target.upsert(rows)
    else:
        target.replace(rows)
    return target.read()
