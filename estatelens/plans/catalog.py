"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator key.

Every query reads the driver tables through ``sources.adapters`` and runs the library job on them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (bool_label, floor, fold, leading_number, market, price_per_m, price_per_sqm_expr, rooms,
                         to_utc_wallclock)
from ..session import scratch_path, written
from ..sources import adapters as A
from ..sources import batches
from ..sources.buckets import BucketTable
from ..sources.tables import TableStore
from ..operators import checks, linkage, normalize, quality, scd2
from . import assertions, incremental, marts, params, reports, staging, star

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# ---- shared inputs -------------------------------------------------------------------------

def raw(spark, d):
    return A.raw_from_events(spark, d)


def lookup(spark, d):
    return A.lookup_from_nations(spark, d)


def stg(spark, d):
    return staging.stg_listings(raw(spark, d), lookup(spark, d))


def fact(spark, d):
    return star.fact(stg(spark, d))


# ---- A: sources ------------------------------------------------------------------------------

@register("stg_renamed")
def q_stg_renamed(spark, d):
    return staging.renamed(raw(spark, d), lookup(spark, d))


# ---- E: staging ------------------------------------------------------------------------------

@register("stg_city_standard")
def q_stg_city_standard(spark, d):
    return staging.renamed(raw(spark, d), lookup(spark, d)).select(
        "listing_id", "date_collected", "source_city_raw", "city")


@register("stg_published_ts")
def q_stg_published_ts(spark, d):
    return raw(spark, d).select(F.col("id").alias("listing_id"), "date_collected", "created_time",
                                to_utc_wallclock(F.col("created_time")).alias("date_published"))


@register("stg_filtered")
def q_stg_filtered(spark, d):
    return staging.in_bounds(staging.renamed(raw(spark, d), lookup(spark, d)))


@register("stg_listings")
def q_stg_listings(spark, d):
    return stg(spark, d)


@register("surrogate_keys")
def q_surrogate_keys(spark, d):
    return fact(spark, d).select("listing_key", "listing_id", "city_key", "district_key",
                                 "building_type_key", "market_key")


@register("ppsm_rows")
def q_ppsm_rows(spark, d):
    return raw(spark, d).select(F.col("id").alias("listing_id"), "date_collected", "price", "area_sqm",
                                price_per_sqm_expr().alias("price_per_sqm_calculated"))


@register("int_listings_daily")
def q_int_listings_daily(spark, d):
    return staging.listings_daily(raw(spark, d), lookup(spark, d))


# ---- F: star schema --------------------------------------------------------------------------

@register("dim_city")
def q_dim_city(spark, d):
    return star.dim_city(stg(spark, d), lookup(spark, d))


@register("dim_district")
def q_dim_district(spark, d):
    return star.dim_district(stg(spark, d))


@register("dim_building_type")
def q_dim_building_type(spark, d):
    return star.dim_building_type(stg(spark, d))


@register("dim_market")
def q_dim_market(spark, d):
    return star.dim_market(stg(spark, d))


@register("fact_apartments")
def q_fact_apartments(spark, d):
    return fact(spark, d)


# ---- G: marts --------------------------------------------------------------------------------

@register("mart_price_statistics")
def q_mart_price_statistics(spark, d):
    return marts.price_statistics(fact(spark, d))


@register("mart_city_summary")
def q_mart_city_summary(spark, d):
    s = stg(spark, d)
    return marts.city_summary(star.fact(s), star.dim_city(s, lookup(spark, d)))


@register("mart_district_summary")
def q_mart_district_summary(spark, d):
    s = stg(spark, d)
    return marts.district_summary(star.fact(s), star.dim_district(s))


@register("mart_market_trends")
def q_mart_market_trends(spark, d):
    return marts.market_trends(staging.listings_daily(raw(spark, d), lookup(spark, d)))


# ---- D: quality gate -------------------------------------------------------------------------

def gate_input(spark, d):
    return A.gate_batches_from_events(spark, d)


def gate_run(spark, d, cities=None):
    b = gate_input(spark, d)
    if cities is not None:
        b = b.filter(F.col("source_city").isin(list(cities)))
    return quality.gate(b, seed=lookup(spark, d))


RULE_COLS = ["source_city", "batch_date", "suite", "expectation", "column", "rule_kind", "mostly", "success",
             "unexpected_count", "unexpected_percent", "element_count"]


@register("dq_ppsm_gap")
def q_dq_ppsm_gap(spark, d):
    return quality.ppsm_gap(gate_input(spark, d)).select(
        "source_city", "batch_date", "seq", "id", "price", "area_sqm", "price_per_sqm_listed", quality.GAP)


def _rule_query(kind):
    def fn(spark, d):
        return gate_run(spark, d).rule_results.filter(F.col("rule_kind") == kind).select(*RULE_COLS)
    return fn


for _key, _kind in [("dq_not_null", "not_null"), ("dq_unique", "unique"), ("dq_between", "between"),
                    ("dq_mostly", "mostly"), ("dq_in_set", "in_set"), ("dq_cross_field", "cross_field"),
                    ("dq_geo_bbox", "geo"), ("dq_warning_rate", "warning")]:
    register(_key)(_rule_query(_kind))


@register("dq_report")
def q_dq_report(spark, d):
    return quality.report(gate_run(spark, d))


@register("dq_clean_rows")
def q_dq_clean_rows(spark, d):
    return gate_run(spark, d).clean


@register("dq_quarantined_rows")
def q_dq_quarantined_rows(spark, d):
    return gate_run(spark, d).quarantine


@register("dq_batch_verdict")
def q_dq_batch_verdict(spark, d):
    return gate_run(spark, d).verdict


@register("dq_gate")
def q_dq_gate(spark, d):
    return quality.run_summary(gate_run(spark, d).verdict)


@register("filter_city_subset")
def q_filter_city_subset(spark, d):
    return gate_run(spark, d, cities=params.SUBSET_CITIES).verdict


# ---- F: day spine, incremental load, merge ---------------------------------------------------

def dim_date_for(spark, d):
    """Spine from 2010-01-01 to one year past the newest collection day."""
    last = staging.max_day(raw(spark, d))
    return star.dim_date(spark, end=star.one_year_after(last))


@register("dim_date")
def q_dim_date(spark, d):
    return dim_date_for(spark, d)


def sparse_raw(spark, d):
    return A.raw_sparse_from_events(spark, d)


def incremental_parts(spark, d):
    """A raw table by day, a fact loaded from the scrapes before the cutoff, and then the rest of the scrapes landed."""
    r, lk = sparse_raw(spark, d), lookup(spark, d)
    cut = F.lit(params.INCREMENTAL_CUTOFF).cast("timestamp_ntz")
    path = scratch_path(spark, "raw-days")
    batches.append_raw(r.filter(F.col("date_collected") < cut), path)
    target = BucketTable(spark, scratch_path(spark, "fact-buckets"), "listing_key", buckets=8)
    incremental.load_fact(spark, path, lk, target)
    batches.append_raw(r.filter(F.col("date_collected") >= cut), path)
    return path, lk, target


@register("fact_incremental_slice")
def q_fact_incremental_slice(spark, d):
    path, lk, target = incremental_parts(spark, d)
    return incremental.changed_listings(spark, path, lk, incremental.first_day(target.read()))


@register("fact_merge")
def q_fact_merge(spark, d):
    path, lk, target = incremental_parts(spark, d)
    incremental.load_fact(spark, path, lk, target)
    return target.read()


@register("fact_schema_sync")
def q_fact_schema_sync(spark, d):
    """The target lacks ``url`` and has a column that the model dropped: kept rows get a null url."""
    path, lk, target = incremental_parts(spark, d)
    target.replace(target.read().drop("url").withColumn("legacy_score", F.lit(1.0)))
    incremental.load_fact(spark, path, lk, target)
    return target.read()


@register("fact_full_refresh")
def q_fact_full_refresh(spark, d):
    """The target holds prices of a mapping that was changed since: an incremental load would keep most of them."""
    path, lk, target = incremental_parts(spark, d)
    target.replace(target.read().withColumn("price", F.col("price") + 1))
    incremental.load_fact(spark, path, lk, target, full_refresh=True)
    return target.read()


# ---- H: history ------------------------------------------------------------------------------

def backfill(spark, d, end):
    daily = staging.stg_daily(raw(spark, d), lookup(spark, d))
    return scd2.scd2_backfill(daily, end, extra=[c for c in scd2.SNAPSHOT_COLUMNS
                                                 if c not in ("listing_id", "price", "listing_status")])


@register("snap_status")
def q_snap_status(spark, d):
    return scd2.snapshot_source(stg(spark, d), params.AS_OF)


@register("snap_scd2_history")
def q_snap_scd2_history(spark, d):
    return backfill(spark, d, params.AS_OF)


@register("snap_scd2_apply")
def q_snap_scd2_apply(spark, d):
    prev = backfill(spark, d, params.AS_OF - dt.timedelta(days=1))
    return scd2.scd2_apply(prev, scd2.snapshot_source(stg(spark, d), params.AS_OF), params.AS_OF)


@register("snap_scd2_partitioned")
def q_snap_scd2_partitioned(spark, d):
    """Several snapshot runs into closed-day partitions: new listings, price changes and listings gone quiet."""
    history = scd2.History(TableStore(spark, scratch_path(spark, "history")), "snapshots_listings")
    r, lk = sparse_raw(spark, d), lookup(spark, d)
    for day in params.SNAPSHOT_DAYS:
        seen = r.filter(F.col("date_collected") < F.lit(day + dt.timedelta(days=1)).cast("timestamp_ntz"))
        history.apply(scd2.snapshot_source(staging.stg_listings(seen, lk), day), day)
    return history.read()


@register("report_listing_history")
def q_report_listing_history(spark, d):
    return scd2.history_of(backfill(spark, d, params.AS_OF), params.HISTORY_LISTING_ID)


# ---- I: data checks --------------------------------------------------------------------------

def star_models(spark, d):
    s = stg(spark, d)
    lk = lookup(spark, d)
    return s, lk, star.fact(s), star.dim_city(s, lk)


@register("chk_unique")
def q_chk_unique(spark, d):
    return checks.unique(raw(spark, d), "id")


@register("chk_not_null")
def q_chk_not_null(spark, d):
    s, lk, _, dc = star_models(spark, d)
    return checks.not_null(dc, "voivodeship")


@register("chk_relationships")
def q_chk_relationships(spark, d):
    return checks.relationships(stg(spark, d), "city", lookup(spark, d), "city_name").select("listing_id", "city")


@register("chk_accepted_values")
def q_chk_accepted_values(spark, d):
    return checks.accepted_values(stg(spark, d), "market_type", ["primary", "secondary"])


@register("chk_expression")
def q_chk_expression(spark, d):
    return checks.expression_is_true(raw(spark, d), "price_per_sqm_listed * area_sqm <= price * 1.1D")


@register("chk_unique_combo")
def q_chk_unique_combo(spark, d):
    s = stg(spark, d)
    return checks.unique_combination(marts.district_summary(star.fact(s), star.dim_district(s)), ["city", "district"])


@register("chk_fk_where")
def q_chk_fk_where(spark, d):
    spine = dim_date_for(spark, d).filter(F.col("date_day") >= F.lit(params.SPINE_FROM))
    sparse = star.fact(staging.stg_listings(sparse_raw(spark, d), lookup(spark, d)))
    return checks.relationships(sparse, "date_published_key", spine, "date_key",
                                where="date_published_key is not null").select("listing_id", "date_published_key")


@register("chk_price_bounds")
def q_chk_price_bounds(spark, d):
    # before the bounds filter, with the price of the whole area listed: zero for listings without an area
    rows = staging.renamed(raw(spark, d), lookup(spark, d))
    return assertions.price_within_bounds(rows.withColumn("price", F.col("price") * F.col("area_sqm")))


@register("chk_area_bounds")
def q_chk_area_bounds(spark, d):
    return assertions.area_within_bounds(staging.renamed(raw(spark, d), lookup(spark, d)))


@register("chk_ppsm")
def q_chk_ppsm(spark, d):
    return assertions.price_per_sqm_consistent(stg(spark, d))


@register("chk_geo")
def q_chk_geo(spark, d):
    return assertions.geo_within_city_bounds(stg(spark, d), lookup(spark, d))


@register("chk_reconcile")
def q_chk_reconcile(spark, d):
    """A mart built before the last scrapes landed does not add up to today's listings."""
    r, lk = sparse_raw(spark, d), lookup(spark, d)
    before = staging.stg_listings(r.filter(F.col("date_collected") < F.lit(params.INCREMENTAL_CUTOFF).cast("timestamp_ntz")), lk)
    stale = marts.city_summary(star.fact(before), star.dim_city(before, lk))
    return assertions.mart_reconciles(stale, staging.stg_listings(r, lk))


@register("chk_summary")
def q_chk_summary(spark, d):
    r, lk = raw(spark, d), lookup(spark, d)
    models = assertions.built_models(spark, r, lk, staging.stg_listings(r, lk), staging.listings_daily(r, lk), dim_date_for(spark, d))
    return checks.run_declared(assertions.declared(), models, assertions.frames(models))


# ---- J: reports ------------------------------------------------------------------------------

@register("report_top_districts")
def q_report_top_districts(spark, d):
    s = stg(spark, d)
    return reports.top_districts(marts.district_summary(star.fact(s), star.dim_district(s)))


@register("report_trend_month")
def q_report_trend_month(spark, d):
    return reports.trend_month(q_mart_market_trends(spark, d))


@register("report_region_rollup")
def q_report_region_rollup(spark, d):
    s, lk, f, dc = star_models(spark, d)
    return reports.region_rollup(f, dc)


@register("report_kpi")
def q_report_kpi(spark, d):
    return reports.kpi(marts.price_statistics(fact(spark, d)))


@register("report_daily_volume")
def q_report_daily_volume(spark, d):
    return reports.daily_volume(fact(spark, d), dim_date_for(spark, d))


@register("report_market_compare")
def q_report_market_compare(spark, d):
    s = stg(spark, d)
    return reports.market_compare(star.fact(s), star.dim_market(s))


@register("report_top_cities")
def q_report_top_cities(spark, d):
    s, lk, f, dc = star_models(spark, d)
    return reports.top_cities(marts.city_summary(f, dc))


@register("report_dual_series")
def q_report_dual_series(spark, d):
    return reports.dual_series(fact(spark, d))


@register("report_map_points")
def q_report_map_points(spark, d):
    s, lk, f, dc = star_models(spark, d)
    return reports.map_points(f, dc)


# ---- B: normalisation of nested items --------------------------------------------------------

def items(spark, d):
    return A.items_from_events(spark, d)


def item_labels(spark, d):
    good, _ = normalize.split_malformed(items(spark, d))
    return normalize.params_to_columns(normalize.flatten_items(good))


@register("norm_flatten")
def q_norm_flatten(spark, d):
    good, _ = normalize.split_malformed(items(spark, d))
    return normalize.flatten_items(good).drop("params")


@register("norm_params")
def q_norm_params(spark, d):
    return item_labels(spark, d).select("source_city", "seq", "id", "price", "currency", *normalize.PARAM_KEYS)


@register("norm_area")
def q_norm_area(spark, d):
    return item_labels(spark, d).select("seq", "id", "m", leading_number(F.col("m")).alias("area_sqm"),
                                        "rent", leading_number(F.col("rent")).alias("extra_rent_pln"))


@register("norm_rooms")
def q_norm_rooms(spark, d):
    r = rooms(F.col("rooms"))
    return item_labels(spark, d).select("seq", "rooms", r["num_rooms"].alias("num_rooms"),
                                        r["rooms_capped"].alias("rooms_capped"))


@register("norm_floor")
def q_norm_floor(spark, d):
    f = floor(F.col("floor_select"))
    return item_labels(spark, d).select("seq", "floor_select", f["floor"].alias("floor"),
                                        f["floor_capped"].alias("floor_capped"))


@register("norm_bool")
def q_norm_bool(spark, d):
    return item_labels(spark, d).select("seq", "furniture", bool_label(F.col("furniture")).alias("is_furnished"))


@register("norm_market")
def q_norm_market(spark, d):
    return item_labels(spark, d).select("seq", "market", market(F.col("market")).alias("market_type"))


@register("norm_ppsm")
def q_norm_ppsm(spark, d):
    return item_labels(spark, d).select("seq", "price_per_m",
                                        price_per_m(F.col("price_per_m")).alias("price_per_sqm_listed"))


@register("norm_malformed_count")
def q_norm_malformed_count(spark, d):
    return normalize.malformed_counts(items(spark, d), ["source_city", "batch_date"])


@register("dedup_last_wins")
def q_dedup_last_wins(spark, d):
    return normalize.normalize(items(spark, d), params.COLLECTED_AT)


# ---- C: location linkage ---------------------------------------------------------------------

def capture_entries(spark, d):
    return linkage.parse_capture_docs(A.captures_from_suppliers(spark, d))


@register("text_fold")
def q_text_fold(spark, d):
    e = capture_entries(spark, d)
    return e.select("doc_id", "pos", "city_name", fold(F.col("city_name")).alias("city_norm"),
                    "region_name", fold(F.col("region_name")).alias("region_norm"))


@register("link_candidates")
def q_link_candidates(spark, d):
    return linkage.candidates(capture_entries(spark, d))


def link_matches(spark, d):
    return linkage.link(lookup(spark, d), linkage.candidates(capture_entries(spark, d)))


@register("link_match")
def q_link_match(spark, d):
    return link_matches(spark, d)


@register("link_report")
def q_link_report(spark, d):
    return linkage.link_report(link_matches(spark, d))


@register("link_unmapped")
def q_link_unmapped(spark, d):
    targets = A.scrape_targets(spark, d)
    return linkage.coverage(targets, linkage.location_ids(link_matches(spark, d)))


# ---- A: sources and sinks (round trips through the shared scratch folder) --------------------

def landing_rows(spark, d):
    """Normalised batches as the scraper lands them (the 22 raw columns + batch_date)."""
    return normalize.normalize(items(spark, d), params.COLLECTED_AT).drop("seq")


@register("sink_landing_roundtrip")
def q_sink_landing_roundtrip(spark, d):
    root = scratch_path(spark, "landing")
    rows = landing_rows(spark, d)
    batches.write_landing(rows, root)
    return batches.read_batches(spark, root)


@register("src_batch_rows")
def q_src_batch_rows(spark, d):
    root = scratch_path(spark, "arrays")
    batches.write_array_files(landing_rows(spark, d), root)
    return batches.read_batches(spark, root, layout="arrays")


@register("src_batch_status")
def q_src_batch_status(spark, d):
    """Array files of all cities, one of them cut off in the middle: that city's batch is blocked, the others pass."""
    root = scratch_path(spark, "arrays")
    batches.write_array_files(landing_rows(spark, d), root)
    batch = f"{root}/source_city={params.SUBSET_CITIES[0]}/batch_date={params.BATCH_DATE}"
    spark.createDataFrame([('[{"id": 1, "title": "cut o',)], "value string").coalesce(1).write.mode("append").text(batch)
    landed = batches.load_batches(spark, root, layout="arrays")
    kept = landed.rows.groupBy(*batches.PARTITIONS).agg(F.count(F.lit(1)).alias("loaded"))
    return landed.status.join(kept, batches.PARTITIONS, "left").select(*batches.PARTITIONS, "rows", "corrupt_records", "readable", F.coalesce("loaded", F.lit(0)).alias("loaded"))


@register("sink_raw_append")
def q_sink_raw_append(spark, d):
    path = scratch_path(spark, "raw")
    rows = written(landing_rows(spark, d), "delivery")  # delivered twice, normalised once
    batches.append_raw(rows, path)
    batches.append_raw(rows, path)  # a rerun of the same delivery: append keeps both copies
    return batches.read_raw(spark, path)


@register("src_city_lookup")
def q_src_city_lookup(spark, d):
    path = scratch_path(spark, "seed")
    batches.write_seed(lookup(spark, d), path)
    return batches.read_seed(spark, path)


# ---- K: the daily job, and the streaming incremental load --------------------------------------

@register("pipeline_daily")
def q_pipeline_daily(spark, d):
    """One daily run over the gate batches (all cities); returns the fact table it produced."""
    from . import pipeline
    store = TableStore(spark, scratch_path(spark, "warehouse"))
    pipeline.run_daily(spark, gate_input(spark, d), params.AS_OF, store, lookup(spark, d),
                       collected_at=params.COLLECTED_AT)
    return store.bucketed("fact_apartments", "listing_key").read()


@register("fact_stream_incremental")
def q_fact_stream_incremental(spark, d):
    """The raw table drained through the streaming merge in several micro-batches; must equal the
    full rebuild of the fact."""
    from ..streaming import incremental as stream
    raw_path = scratch_path(spark, "raw-stream")
    batches.append_raw(raw(spark, d), raw_path)
    store = TableStore(spark, scratch_path(spark, "stream-store"))
    return stream.run_incremental(spark, raw_path, store, lookup(spark, d),
                                  checkpoint=scratch_path(spark, "stream-ckpt"), max_files_per_trigger=150)


# ---- lineitem adapter: the bench workloads (seven years of scrapes, ties broken by line keys) -----

LI_TIEBREAK = ["l_linenumber", "l_partkey", "l_suppkey"]


def li_raw(spark, d):
    return A.raw_from_lineitem(spark, d)


def li_stg(spark, d):
    return staging.stg_listings(li_raw(spark, d), lookup(spark, d), tiebreak=LI_TIEBREAK)


@register("li_stg_listings")
def q_li_stg_listings(spark, d):
    return li_stg(spark, d)


@register("li_market_trends")
def q_li_market_trends(spark, d):
    return marts.market_trends(staging.listings_daily(li_raw(spark, d), lookup(spark, d), tiebreak=LI_TIEBREAK))


@register("li_city_summary")
def q_li_city_summary(spark, d):
    s = li_stg(spark, d)
    return marts.city_summary(star.fact(s), star.dim_city(s, lookup(spark, d)))


@register("li_district_summary")
def q_li_district_summary(spark, d):
    s = li_stg(spark, d)
    return marts.district_summary(star.fact(s), star.dim_district(s))


@register("li_price_statistics")
def q_li_price_statistics(spark, d):
    return marts.price_statistics(star.fact(li_stg(spark, d)))
