"""Type-2 history (check strategy on price + listing status, no hard deletes).

``scd2_step`` is one snapshot run: open versions FULL OUTER JOIN incoming rows on the key; a version
is closed and a new one opened when a checked column changes (null-safe); keys missing from the
input keep their open version. Both sides are shuffled once on the key. ``History`` stores the result.

``scd2_backfill`` builds the whole history for a date range in one job (no day loop): per listing,
the daily rows give the state changes directly -- each scrape day sets (price, active); when the
next scrape is more than ``removed_after`` days away (or absent) the state turns likely_removed on
day + ``removed_after``. Consecutive equal states collapse with ``lag``; ``valid_to`` is the next
version's start (``lead``). Windows are partitioned by listing, so one listing's history is one group
of at most (days in range) rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import utc_day
from ..session import written

ACTIVE, REMOVED = "active", "likely_removed"
RECENT_DAYS = 2          # active iff collected day >= as_of - 2
VALID_FROM, VALID_TO = "dbt_valid_from", "dbt_valid_to"
SNAPSHOT_COLUMNS = ["listing_key", "listing_id", "city", "district", "price", "area_sqm", "market_type",
                    "date_collected", "listing_status"]
CHECK_COLUMNS = ("price", "listing_status")


def listing_status(collected: Column, as_of: dt.date) -> Column:
    return F.when(utc_day(collected) >= F.date_sub(F.lit(as_of), RECENT_DAYS), F.lit(ACTIVE)).otherwise(F.lit(REMOVED))


def snapshot_source(stg: DataFrame, as_of: dt.date) -> DataFrame:
    return stg.select(*SNAPSHOT_COLUMNS[:-1], listing_status(F.col("date_collected"), as_of).alias("listing_status"))


def _changed(a: str, b: str, cols: Sequence[str]) -> Column:
    same = F.lit(True)
    for c in cols:
        same = same & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return ~same


def scd2_step(open_: DataFrame | None, current: DataFrame, as_of: dt.date, key: str = "listing_key",
              check_cols: Sequence[str] = CHECK_COLUMNS) -> DataFrame:
    """The versions that one run makes of the open ones: one join, and one or two rows for each key."""
    cols = list(current.columns)
    none = F.lit(None).cast("date")
    if open_ is None:
        return current.select(*cols, F.lit(as_of).alias(VALID_FROM), none.alias(VALID_TO))
    j = open_.alias("h").join(current.alias("c"), F.col(f"h.{key}") == F.col(f"c.{key}"), "full_outer")
    had, comes = F.col(f"h.{key}").isNotNull(), F.col(f"c.{key}").isNotNull()

    def version(side: str, start: Column, end: Column) -> Column:
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in cols], start.alias(VALID_FROM), end.alias(VALID_TO))

    kept = version("h", F.col(f"h.{VALID_FROM}"), none)
    closed, opened = version("h", F.col(f"h.{VALID_FROM}"), F.lit(as_of)), version("c", F.lit(as_of), none)
    made = F.when(~had, F.array(opened)).when(comes & _changed("h", "c", check_cols), F.array(closed, opened)).otherwise(F.array(kept))
    return j.select(F.explode(made).alias("v")).select("v.*")


def scd2_apply(history: DataFrame | None, current: DataFrame, as_of: dt.date, key: str = "listing_key",
               check_cols: Sequence[str] = CHECK_COLUMNS) -> DataFrame:
    """A whole history after one run (``History`` keeps closed versions apart and never rewrites them)."""
    if history is None:
        return scd2_step(None, current, as_of, key, check_cols)
    step = scd2_step(history.filter(F.col(VALID_TO).isNull()), current, as_of, key, check_cols)
    return history.filter(F.col(VALID_TO).isNotNull()).select(*step.columns).unionByName(step)


class History:
    """A type-2 history whose closed versions lie in append-only partitions by the day they were closed.

    A run joins the open versions, one row per key, with the incoming rows and writes the versions it closes under
    (day closed, open version it started from) before the new open ones. A run repeated after a crash starts from the same open version and
    overwrites its own partition only; closed rows of a run that never finished are not read.
    """

    def __init__(self, store, name: str, key: str = "listing_key", check_cols: Sequence[str] = CHECK_COLUMNS):
        self.store, self.name, self.key, self.check_cols = store, name, key, check_cols
        self.closed_path = f"{store.root}/{name}_closed"

    def _base(self) -> str:
        path = self.store.current_path(f"{self.name}_open")
        return path.rsplit("/", 1)[1] if path else "none"

    def apply(self, current: DataFrame, as_of: dt.date) -> None:
        step = written(scd2_step(self.store.read(f"{self.name}_open"), current, as_of, self.key, self.check_cols), "history-step")
        closed = step.where(F.col(VALID_TO).isNotNull()).withColumn("_run", F.lit(self._base()))
        (closed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(VALID_TO, "_run").parquet(self.closed_path))
        self.store.write(f"{self.name}_open", step.where(F.col(VALID_TO).isNull()))

    def read(self) -> DataFrame | None:
        open_ = self.store.read(f"{self.name}_open")
        if open_ is None:
            return None
        fields = [f for f in open_.schema.fields if f.name != VALID_TO]
        schema = T.StructType([*fields, T.StructField(VALID_TO, T.DateType()), T.StructField("_run", T.StringType())])
        closed = open_.sparkSession.read.schema(schema).parquet(self.closed_path).where(F.col("_run") != self._base())
        return closed.drop("_run").unionByName(open_)


def scd2_backfill(daily: DataFrame, end: dt.date, key: str = "listing_id",
                  removed_after: int = RECENT_DAYS + 1, value: str = "price",
                  extra: Sequence[str] = ()) -> DataFrame:
    """Closed-form history from the daily grain (one row per key per day) through ``end``."""
    d = daily.filter(utc_day("date_collected") <= F.lit(end)).select(
        key, utc_day("date_collected").alias("_day"), value, *extra)
    w = Window.partitionBy(key).orderBy("_day")
    d = d.withColumn("_next", F.lead("_day").over(w))
    scrape = d.select(key, "_day", value, *extra, F.lit(ACTIVE).alias("listing_status"), F.lit(0).alias("_ord"))
    gone_day = F.date_add(F.col("_day"), removed_after)
    removed = d.filter((F.col("_next").isNull() | (F.col("_next") > gone_day)) & (gone_day <= F.lit(end))) \
        .select(key, gone_day.alias("_day"), value, *extra, F.lit(REMOVED).alias("listing_status"), F.lit(1).alias("_ord"))
    ev = scrape.unionByName(removed)
    we = Window.partitionBy(key).orderBy("_day", "_ord")
    ev = ev.withColumn("_pv", F.lag(value).over(we)).withColumn("_ps", F.lag("listing_status").over(we)) \
        .withColumn("_first", F.row_number().over(we) == 1)
    kept = ev.filter(F.col("_first") | ~(F.col(value).eqNullSafe(F.col("_pv")) & F.col("listing_status").eqNullSafe(F.col("_ps"))))
    wk = Window.partitionBy(key).orderBy("_day")
    return kept.select(key, value, *extra, "listing_status", F.col("_day").alias(VALID_FROM),
                       F.lead("_day").over(wk).alias(VALID_TO))


def history_of(history: DataFrame, listing_id) -> DataFrame:
    return history.filter(F.col("listing_id") == F.lit(listing_id)).select(
        "listing_id", "price", "listing_status", VALID_FROM, VALID_TO).orderBy(VALID_FROM)
