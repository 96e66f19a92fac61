"""The daily job (one Spark application for all cities; cities are a grouping key, not a loop).

items -> normalise -> typed batches -> quality gate -> quarantine + report tables -> append clean rows to raw ->
staging (view) + daily grain (ephemeral) -> dimensions (tables) -> fact (incremental merge) ->
marts (tables) -> type-2 snapshot -> data checks -> exit verdict.

Every table is written as a new version in the shared store (see ``sources.tables``), which also
cuts the lineage between stages: a lost executor re-runs at most the current stage.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks, normalize, quality, scd2
from ..sources import batches as B
from ..sources.tables import RunLog, TableStore
from . import assertions, incremental, marts, staging, star


@dataclass
class RunResult:
    run_date: dt.date
    verdict: DataFrame
    checks: DataFrame
    batches_blocked: int
    batches_total: int
    checks_failed: int
    run_failed: bool


def run_daily_items(spark: SparkSession, items: DataFrame, run_date: dt.date, store: TableStore, seed: DataFrame | None,
                    collected_at: str | None = None, **options) -> RunResult:
    """The daily job from scraped items (source_city, batch_date, seq, item_json): normalised, counted and landed first.

    Malformed items are skipped and counted per batch; of an id that a batch holds twice the last item stays.
    """
    stamp = collected_at or f"{run_date.isoformat()} 00:00:00"
    store.write("normalize_report", normalize.malformed_counts(items, list(B.PARTITIONS)))
    typed = normalize.normalize(items, stamp)
    store.write("landed", typed)
    return run_daily(spark, store.read("landed"), run_date, store, seed, **options)


def run_daily(spark: SparkSession, batches: DataFrame, run_date: dt.date, store: TableStore, seed: DataFrame | None,
              collected_at: str | None = None, cities: Sequence[str] | None = None,
              raw_mode: str = "append", geo_severity: str = "error", full_refresh: bool = False,
              status: DataFrame | None = None) -> RunResult:
    """One day's run over typed city batches. ``status`` (``batches.Landing``) names batches that could not be read: they
    count as blocked. A run that died is repeated without appending its rows twice (``RunLog``); a further run of a
    finished day appends its delivery again. Without a seed the geo rule and the tests on the seed are left out."""
    if cities is not None:
        batches = batches.filter(F.col("source_city").isin(list(cities)))
    if "date_collected" not in batches.columns:
        stamp = collected_at or f"{run_date.isoformat()} 00:00:00"
        batches = batches.withColumn("date_collected", F.lit(stamp).cast("timestamp_ntz"))
    log = RunLog(store, run_date.isoformat())

    # gate: flagged rows are written once; verdict, report, quarantine and clean rows are read from them
    gate = quality.gate(batches, seed=seed)
    verdict = gate.verdict
    if status is not None:
        unread = status.where(~F.col("readable")).select(
            *B.PARTITIONS, F.col("rows"), F.lit(0).cast("long").alias("quarantined_rows"), F.lit(1.0).alias("quarantine_fraction"),
            F.concat(F.lit("unreadable_records("), F.col("corrupt_records").cast("string"), F.lit(")")).alias("failed_rules"), F.lit(True).alias("systemic_failure"))
        verdict = verdict.unionByName(unread)
    store.write("dq_verdict", verdict)
    ordered = "seq" if "seq" in batches.columns else "id"
    store.write("dq_report", quality.report(gate, seq=ordered))
    store.write("quarantine", gate.quarantine)
    B.write_quarantine(store.read("quarantine"), f"{store.root}/quarantine_json")
    verdict = store.read("dq_verdict")
    first = batches.agg(F.min("date_collected")).first()[0]

    # append the clean rows of passing batches to the raw table (partitioned by day and city)
    raw_path = f"{store.root}/raw_listings"
    B.ensure_raw(spark, raw_path)
    if "raw" not in log.done:
        clean = gate.clean
        if "raw-start" in log.done and raw_mode == "append":  # an earlier try may have written some or all of them
            clean = B.missing_rows(clean, raw_path)
        log.note("raw-start")
        B.append_raw(clean, raw_path, mode=raw_mode)
        log.note("raw")
    raw = B.read_raw(spark, raw_path)

    # staging is a view in the model, but every later table reads it: kept as a table, of which a run rewrites the
    # buckets of the listings scraped since its batches' first day
    state = store.bucketed("stg_listings", "listing_id")
    stg = incremental.load_state(spark, raw_path, seed, state, first if first is None else first.date())
    daily = staging.listings_daily(raw, seed)
    store.write("dim_city", star.dim_city(stg, seed))
    store.write("dim_district", star.dim_district(stg))
    store.write("dim_building_type", star.dim_building_type(stg))
    store.write("dim_market", star.dim_market(stg))
    store.write("dim_date", star.dim_date(spark, end=star.one_year_after(run_date)))
    facts = store.bucketed("fact_apartments", "listing_key")
    incremental.load_fact(spark, raw_path, seed, facts, full_refresh=full_refresh)

    fact = facts.read()
    dim_city, dim_district = store.read("dim_city"), store.read("dim_district")
    store.write("mart_price_statistics", marts.with_generated_at(marts.price_statistics(fact)))
    store.write("mart_city_summary", marts.city_summary(fact, dim_city))
    store.write("mart_district_summary", marts.district_summary(fact, dim_district))
    store.write("mart_market_trends", marts.market_trends(daily))

    current = scd2.snapshot_source(stg, run_date)
    scd2.History(store, "snapshots_listings").apply(current, run_date)

    # tests run against the tables just built, not against recomputed models
    built = {n: store.read(n) for n in ("dim_city", "dim_district", "dim_building_type", "dim_market", "dim_date",
                                        "mart_price_statistics", "mart_city_summary", "mart_district_summary",
                                        "mart_market_trends")}
    built |= {} if seed is None else {"city_lookup": seed}
    built |= {"raw": raw, "stg_listings": stg, "int_listings_daily": daily, "fact_apartments": fact}
    tests = [t for t in assertions.declared(geo_severity) if seed is not None or (t.model, t.column) != ("dim_city", "voivodeship")]
    store.write("check_results", checks.run_declared(tests, built, assertions.frames(built)))
    results = store.read("check_results")

    counts = verdict.agg(F.count(F.lit(1)).alias("n"),
                         F.sum(F.when(F.col("systemic_failure"), 1).otherwise(0)).alias("blocked")).first()
    failed_checks = results.filter(F.col("status") == "fail").count()
    total, blocked = int(counts["n"] or 0), int(counts["blocked"] or 0)
    log.note("finished")
    run_failed = (total > 0 and blocked == total) or failed_checks > 0
    return RunResult(run_date, verdict, results, blocked, total, failed_checks, run_failed)
