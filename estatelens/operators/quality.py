"""Data-quality gate for city batches: rules, per-batch verdicts, row quarantine.

Semantics (per batch = one city's delivery for one day):

* value rules (between / in-set / unique) ignore nulls; not-null rules count every row;
* a rule with ``mostly`` passes when the share of good values among the counted ones is >= mostly
  (nothing counted = pass). Only rows behind *failed* critical rules are quarantined;
* a uniqueness failure flags every row carrying a duplicated value;
* if the quarantined share is > ``max_quarantine`` the batch is systemic: it is blocked as a whole and
  nothing is dropped row by row; a bad city never stops the other cities;
* warning rules are reported but never quarantine or block.

Execution plan, independent of batch count and size:

1. one projection adds, per rule, a "bad" and a "counted" bit, packed into three int masks;
   duplicate ids come from a partial aggregate on (batch, id) joined back (only keys seen twice);
2. one grouped count on (batch, masks) -- partial before the shuffle, a handful of rows per batch --
   from which every rule verdict, the quarantined count and the systemic verdict follow;
3. one join of the rows with the per-batch verdict (one row per batch) splits clean / quarantined.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import safe_ratio
from ..session import small, written

# The gate's thresholds.
PRICE_MIN, PRICE_MAX = 1, 20_000_000
AREA_MIN, AREA_MAX = 10, 500
ROOMS_MIN, ROOMS_MAX = 1, 10
PRICE_PER_SQM_TOLERANCE = 0.05
QUARANTINE_MAX_FRACTION = 0.05
DISTRICT_NOT_NULL_REFERENCE = 0.6
SAMPLE_SIZE = 20

NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
BETWEEN = "expect_column_values_to_be_between"
IN_SET = "expect_column_values_to_be_in_set"

GAP = "price_per_sqm_diff_pct"
BATCH_KEYS = ("source_city", "batch_date")


@dataclass(frozen=True)
class Rule:
    expectation: str
    column: str
    lo: object = None          # number or column name (per-batch bound)
    hi: object = None
    values: tuple = ()
    mostly: float = 1.0
    suite: str = "critical"
    tag: str = field(default="", compare=False)   # not_null / unique / between / mostly / in_set / cross_field / geo / warning


def critical_rules(geo: bool = True) -> list[Rule]:
    rules = [
        Rule(NOT_NULL, "id", tag="not_null"),
        Rule(UNIQUE, "id", tag="unique"),
        Rule(NOT_NULL, "url", tag="not_null"),
        Rule(NOT_NULL, "city", tag="not_null"),
        Rule(BETWEEN, "price", PRICE_MIN, PRICE_MAX, tag="between"),
        Rule(BETWEEN, "area_sqm", AREA_MIN, AREA_MAX, tag="between"),
        Rule(BETWEEN, "num_rooms", ROOMS_MIN, ROOMS_MAX, mostly=0.95, tag="mostly"),
        Rule(NOT_NULL, "rooms_capped", tag="not_null"),
        Rule(IN_SET, "rooms_capped", values=(True, False), tag="in_set"),
        Rule(NOT_NULL, "floor_capped", tag="not_null"),
        Rule(IN_SET, "floor_capped", values=(True, False), tag="in_set"),
        Rule(IN_SET, "market_type", values=("primary", "secondary"), tag="in_set"),
        Rule(BETWEEN, GAP, 0, PRICE_PER_SQM_TOLERANCE, tag="cross_field"),
    ]
    if geo:
        rules += [Rule(BETWEEN, "latitude", "bbox_lat_min", "bbox_lat_max", tag="geo"),
                  Rule(BETWEEN, "longitude", "bbox_lon_min", "bbox_lon_max", tag="geo")]
    return rules


def warning_rules() -> list[Rule]:
    return [Rule(NOT_NULL, "district", mostly=DISTRICT_NOT_NULL_REFERENCE, suite="warning", tag="warning")]


def ppsm_gap(df: DataFrame) -> DataFrame:
    """Relative gap between listed and computed price per m² (null unless listed and a non-zero
    area are present; listed = 0 gives +inf, or null when the computed value is 0 too)."""
    listed, area = F.col("price_per_sqm_listed"), F.col("area_sqm")
    computed = safe_ratio(F.col("price"), area)
    has_both = listed.isNotNull() & area.isNotNull() & (area != 0)
    gap = F.when(listed == 0, F.when(F.abs(computed) > 0, F.lit(float("inf"))))\
        .otherwise(safe_ratio(F.abs(computed - listed), listed))
    return df.withColumn(GAP, F.when(has_both, gap))


def _bound(v) -> Column:
    return F.col(v) if isinstance(v, str) else F.lit(v)


def _render(c: Column, dtype: str) -> Column:
    """Value as report text: doubles at fixed 6 decimals so every engine prints them alike."""
    if dtype in ("double", "float"):
        txt = c.try_cast("decimal(38,6)").cast("string")
    else:
        txt = c.cast("string")
    return F.coalesce(txt, F.lit("null"))


def _rule_bits(df: DataFrame, rule: Rule) -> tuple[Column, Column, Column]:
    """(bad, counted, applies) for one rule."""
    c = F.col(rule.column)
    applies = F.lit(True)
    if rule.expectation == NOT_NULL:
        return c.isNull(), F.lit(True), applies
    counted = c.isNotNull()
    if rule.expectation == BETWEEN:
        lo, hi = _bound(rule.lo), _bound(rule.hi)
        if isinstance(rule.lo, str) or isinstance(rule.hi, str):
            applies = lo.isNotNull() & hi.isNotNull()
            counted = counted & applies
        bad = counted & ~((c >= lo) & (c <= hi))
    elif rule.expectation == IN_SET:
        bad = counted & ~c.cast("string").isin([str(v).lower() if isinstance(v, bool) else str(v)
                                                for v in rule.values])
    elif rule.expectation == UNIQUE:
        bad = counted & F.col(f"_dup_{rule.column}")
    else:
        raise ValueError(rule.expectation)
    return bad, counted, applies


@dataclass
class GateResult:
    flags: DataFrame        # rows + per-row masks
    rule_results: DataFrame  # one row per (batch, rule) that applies
    verdict: DataFrame       # one row per batch
    clean: DataFrame         # rows of passing batches minus quarantined rows
    quarantine: DataFrame    # quarantined rows of passing batches (original columns)


def _join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on batch keys treating null = null (a batch may have no city); still an equi-join."""
    keys = list(keys)
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def with_bounds(df: DataFrame, seed: DataFrame | None, city_col: str = "source_city") -> DataFrame:
    """Attach the batch city's bounding box (a seed row per city; broadcast: one row per target).
    Seeds without the bbox columns, or cities without a full box, leave the bounds null (rule skipped)."""
    cols = ["bbox_lat_min", "bbox_lat_max", "bbox_lon_min", "bbox_lon_max"]
    if seed is None or not set(cols).issubset(seed.columns):
        out = df
        for c in cols:
            out = out.withColumn(c, F.lit(None).cast("double"))
        return out
    full = F.lit(True)
    for c in cols:
        full = full & F.col(c).isNotNull()
    s = seed.filter(full).select(F.col("source_city").alias("_seed_city"), *cols)
    return df.join(small(s), df[city_col] == F.col("_seed_city"), "left").drop("_seed_city")


def gate(df: DataFrame, seed: DataFrame | None = None, batch_keys: Sequence[str] = BATCH_KEYS,
         rules: Sequence[Rule] | None = None, warnings: Sequence[Rule] | None = None,
         max_quarantine: float = QUARANTINE_MAX_FRACTION, city_col: str = "source_city",
         materialize: bool = True) -> GateResult:
    keys = list(batch_keys)
    original = df.columns
    has_geo = {"latitude", "longitude"}.issubset(df.columns)
    rules = list(rules if rules is not None else critical_rules(geo=has_geo))
    warnings = list(warnings if warnings is not None else warning_rules())
    all_rules = rules + warnings
    if len(all_rules) > 30:
        raise ValueError("at most 30 rules per gate")

    x = ppsm_gap(df) if GAP not in df.columns and {"price", "area_sqm", "price_per_sqm_listed"} <= set(df.columns) else df
    if any(isinstance(r.lo, str) for r in all_rules):
        x = with_bounds(x, seed, city_col)
    for col in {r.column for r in all_rules if r.expectation == UNIQUE}:
        dups = (x.filter(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_n"))
                .filter(F.col("_n") > 1).select(*keys, col, F.lit(True).alias(f"_dup_{col}")))
        x = _join(x, dups, [*keys, col], "left").withColumn(f"_dup_{col}", F.coalesce(F.col(f"_dup_{col}"), F.lit(False)))

    bad_m, cnt_m, app_m = F.lit(0), F.lit(0), F.lit(0)
    for i, r in enumerate(all_rules):
        bad, counted, applies = _rule_bits(x, r)
        bit = F.lit(1 << i)
        bad_m = bad_m + F.when(bad, bit).otherwise(0)
        cnt_m = cnt_m + F.when(counted, bit).otherwise(0)
        app_m = app_m + F.when(applies, bit).otherwise(0)
    flags = x.withColumn("_bad", bad_m).withColumn("_cnt", cnt_m).withColumn("_app", app_m)
    if materialize:
        # rows and masks once: statistics, report and both outputs read this table, not the input
        flags = written(flags, "gate-flags")

    stats = flags.groupBy(*keys, "_bad", "_cnt", "_app").agg(F.count(F.lit(1)).alias("_n"))
    if materialize:
        # the per-batch mask counts are tiny and every verdict below derives from them
        stats = written(stats, "gate-stats")

    # per (batch, rule) counts, on the small stats table
    spec = F.array(*[F.struct(F.lit(i).alias("idx"), F.lit(r.expectation).alias("expectation"),
                              F.lit(r.column).alias("column"), F.lit(float(r.mostly)).alias("mostly"),
                              F.lit(r.suite).alias("suite"), F.lit(r.tag).alias("tag"))
                     for i, r in enumerate(all_rules)])
    per = stats.select(*keys, "_bad", "_cnt", "_app", "_n", F.explode(spec).alias("r"))
    bitc = F.expr("shiftleft(1, r.idx)")
    per = per.groupBy(*keys, "r").agg(
        F.sum(F.when((F.col("_bad").bitwiseAND(bitc)) != 0, F.col("_n")).otherwise(0)).alias("unexpected_count"),
        F.sum(F.when((F.col("_cnt").bitwiseAND(bitc)) != 0, F.col("_n")).otherwise(0)).alias("counted"),
        F.sum("_n").alias("element_count"),
        F.max((F.col("_app").bitwiseAND(bitc)) != 0).alias("applies"),
    ).filter("applies")
    good_share = (F.col("counted") - F.col("unexpected_count")).cast("double") / F.col("counted").cast("double")
    rule_results = per.select(
        *keys,
        F.col("r.suite").alias("suite"), F.col("r.expectation").alias("expectation"),
        F.col("r.column").alias("column"), F.col("r.tag").alias("rule_kind"), F.col("r.idx").alias("rule_idx"),
        F.col("r.mostly").alias("mostly"),
        ((F.col("counted") == 0) | (good_share >= F.col("r.mostly"))).alias("success"),
        F.col("unexpected_count").cast("long").alias("unexpected_count"),
        F.when(F.col("counted") > 0, F.col("unexpected_count").cast("double") * 100.0 / F.col("counted").cast("double"))
         .alias("unexpected_percent"),
        F.col("element_count").cast("long").alias("element_count"),
    )

    failed = rule_results.filter((F.col("suite") == "critical") & ~F.col("success")) \
        .groupBy(*keys).agg(F.sum(F.expr("shiftleft(1, rule_idx)")).cast("int").alias("_failed_mask"),
                            F.array_sort(F.collect_list(F.concat(F.col("expectation"), F.lit("("), F.col("column"), F.lit(")"))))
                            .alias("failed_rules"))
    batch_rows = stats.groupBy(*keys).agg(F.sum("_n").alias("rows"))
    sv = _join(stats, failed, keys, "left").withColumn("_failed_mask", F.coalesce("_failed_mask", F.lit(0)))
    qcount = sv.groupBy(*keys).agg(
        F.sum(F.when((F.col("_bad").bitwiseAND(F.col("_failed_mask"))) != 0, F.col("_n")).otherwise(0)).alias("quarantined"))
    verdict = (_join(_join(batch_rows, qcount, keys), failed, keys, "left")
               .select(*keys, F.col("rows").cast("long").alias("rows"),
                       F.col("quarantined").cast("long").alias("quarantined_rows"),
                       (F.col("quarantined").cast("double") / F.col("rows").cast("double")).alias("quarantine_fraction"),
                       F.coalesce("_failed_mask", F.lit(0)).alias("_failed_mask"),
                       F.coalesce(F.array_join("failed_rules", ", "), F.lit("")).alias("failed_rules")))
    verdict = verdict.withColumn("systemic_failure", F.col("quarantine_fraction") > F.lit(max_quarantine))

    # one row per batch: AQE broadcasts it at run time when small (it is: cities x days)
    v = verdict.select(*keys, "_failed_mask", "systemic_failure")
    joined = _join(flags, v, keys, "inner")
    row_bad = (F.col("_bad").bitwiseAND(F.col("_failed_mask"))) != 0
    quarantine = joined.filter(~F.col("systemic_failure") & row_bad).select(*original)
    clean = joined.filter(~F.col("systemic_failure") & ~row_bad).select(*original)
    return GateResult(flags=flags, rule_results=rule_results, verdict=verdict.drop("_failed_mask"),
                      clean=clean, quarantine=quarantine)


def report(res: GateResult, df_rules: Sequence[Rule] | None = None, seq: str = "seq",
           keys: Sequence[str] = BATCH_KEYS) -> DataFrame:
    """Rule report with up to ``SAMPLE_SIZE`` unexpected values per (batch, rule), in row order.

    Only unexpected cells are exploded; ``row_number <= k`` becomes a partial top-k per group
    (WindowGroupLimit), so a hot batch never ships all its bad rows to one task.
    """
    keys = list(keys)
    flags = res.flags
    rules_df = res.rule_results
    cells = []
    dtypes = dict(flags.dtypes)
    all_rules = df_rules
    if all_rules is None:
        has_geo = {"latitude", "longitude"}.issubset(flags.columns)
        all_rules = critical_rules(geo=has_geo) + warning_rules()
    for i, r in enumerate(all_rules):
        cells.append(F.when((F.col("_bad").bitwiseAND(F.lit(1 << i))) != 0,
                            F.struct(F.lit(i).alias("rule_idx"), _render(F.col(r.column), dtypes.get(r.column, "string")).alias("v"))))
    bad = flags.filter(F.col("_bad") != 0).select(*keys, F.col(seq).alias("_seq"), F.explode(F.array(*cells)).alias("c")) \
        .filter(F.col("c").isNotNull()).select(*keys, "_seq", "c.rule_idx", "c.v")
    w = Window.partitionBy(*keys, "rule_idx").orderBy("_seq")
    top = bad.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= SAMPLE_SIZE)
    samples = top.groupBy(*keys, "rule_idx").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rn", "v"))), lambda s: s["v"]), ", ")
        .alias("sample_values"))
    return _join(rules_df, samples, [*keys, "rule_idx"], "left").select(
        *keys, "suite", "expectation", "column", "rule_kind", "success", "unexpected_count",
        "unexpected_percent", "element_count", F.coalesce("sample_values", F.lit("")).alias("sample_values"))


def run_summary(verdict: DataFrame) -> DataFrame:
    """Per run day: batches passed / blocked, rows kept / quarantined; the run fails only if every
    batch is blocked (a bad city never stops the others)."""
    sys_ = F.col("systemic_failure")
    return verdict.groupBy("batch_date").agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum(F.when(sys_, 0).otherwise(1)).cast("long").alias("passed_batches"),
        F.sum(F.when(sys_, 1).otherwise(0)).cast("long").alias("blocked_batches"),
        F.sum(F.when(sys_, 0).otherwise(F.col("rows") - F.col("quarantined_rows"))).cast("long").alias("clean_rows"),
        F.sum(F.when(sys_, 0).otherwise(F.col("quarantined_rows"))).cast("long").alias("quarantined_rows"),
        F.bool_and(sys_).alias("run_failed"),
    )
