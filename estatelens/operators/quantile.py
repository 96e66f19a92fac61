"""Exact discrete quantiles (``percentile_disc``) per group, distributed.

A plain ``percentile_disc`` buffers every value of a group in one task; a hot group (a third of the
rows) would land on a single executor. ``quantiles`` works in two passes over the rows, for all
measures at once, and both aggregate partially before any shuffle:

1. one aggregate per group: a mergeable KLL sketch and the count of every measure, beside any other
   aggregates the caller wants. The sketch gives two values that enclose the wanted rank;
2. values below the lower bound are counted, those within the bounds are counted per distinct value,
   and a running sum over these counts picks the answer. The bounds, one row per group, are written
   first, so the planner broadcasts them only if their measured size allows.

No exchange carries raw rows. The sketch is approximate, so the result says whether the wanted rank
lies within the bounds; should a group's not, or hold more than ``MAX_EXACT_ROWS`` distinct values
between them, that measure is resolved by ``quantile_disc``, which narrows ranges until they fit.
The result is the smallest value whose cumulative share reaches ``p`` (same as percentile_disc).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 64
SKETCH_K = 800  # rank error of the sketch about 0.55 % at 99 % confidence
MARGIN = 0.02  # ranks on either side of the wanted one that the bounds enclose


def _bound(sketch: str, rank: float) -> Column:
    some = F.kll_sketch_get_n_double(sketch) > 0
    return F.when(some, F.kll_sketch_get_quantile_double(F.col(sketch), F.lit(min(1.0, max(0.0, rank)))))


def quantiles(df: DataFrame, measures: Mapping[str, str], keys: Sequence[str] = (), p: float = 0.5,
              also: Sequence[Column] = ()) -> DataFrame:
    """One row per group: ``keys``, the aggregates ``also``, and per alias of ``measures`` the exact
    ``p`` quantile of its column's non-null values (null where a group has none)."""
    from ..session import written

    keys, names, cols = list(keys), list(measures), list(measures.values())
    rows = df.select(*keys, *[F.col(c).alias(f"_v{i}") for i, c in enumerate(cols)])
    value = lambda i: F.col(f"_v{i}").cast("double")
    finite = lambda i: F.when(~F.isnan(value(i)), value(i))
    extra = [c.alias(f"_a{j}") for j, c in enumerate(also)]
    group = df.groupBy(*keys).agg(*extra, *[F.count(c).alias(f"_n{i}") for i, c in enumerate(cols)],
                                  *[F.kll_sketch_agg_double(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")), F.lit(SKETCH_K)).alias(f"_s{i}")
                                    for i, c in enumerate(cols)])
    state = written(group.select(*keys, *[f"_a{j}" for j in range(len(also))], *[f"_n{i}" for i in range(len(cols))],
                                 *[_bound(f"_s{i}", p - MARGIN).alias(f"_lo{i}") for i in range(len(cols))],
                                 *[_bound(f"_s{i}", p + MARGIN).alias(f"_hi{i}") for i in range(len(cols))]), "quantile-state")
    bounds = state.select(*keys, *[f"_{b}{i}" for i in range(len(cols)) for b in ("lo", "hi")])
    if keys:
        near = _same_group(rows, bounds, keys)
    else:  # one row of bounds
        first = bounds.first()
        near = rows.withColumns({c: F.lit(first[c]).cast("double") for c in bounds.columns})
    kinds = {df.schema[c].dataType for c in cols}
    common = kinds.pop().simpleString() if len(kinds) == 1 else "double"

    def part(i: int) -> Column:
        below = F.coalesce(value(i) < F.col(f"_lo{i}"), F.lit(False))
        above = F.coalesce(value(i) > F.col(f"_hi{i}"), F.lit(False))
        at = F.when(~below, F.col(f"_v{i}").cast(common))
        return F.when(F.col(f"_v{i}").isNotNull() & ~above, F.struct(F.lit(i).alias("_m"), at.alias("_v")))

    each = near.select(*keys, F.explode(F.array_compact(F.array(*[part(i) for i in range(len(cols))]))).alias("_x")).select(*keys, "_x._m", "_x._v")
    counts = written(each.groupBy(*keys, "_m", "_v").agg(F.count(F.lit(1)).alias("_c")), "quantile-counts")

    totals = state.select(*keys, F.explode(F.array(*[F.struct(F.lit(i).alias("_m"), F.col(f"_n{i}").alias("_n")) for i in range(len(cols))])).alias("_x")).select(*keys, "_x._m", "_x._n").where(F.col("_n") > 0)
    spread = counts.groupBy(*keys, "_m").agg(F.sum("_c").alias("_upto"), F.sum(F.when(F.col("_v").isNull(), F.col("_c"))).alias("_below"), F.count(F.lit(1)).alias("_values"))
    of = _same_group(totals, spread, [*keys, "_m"])
    wanted = p * F.col("_n")
    missed = (F.coalesce("_below", F.lit(0)) >= wanted) & (F.coalesce("_below", F.lit(0)) > 0) | (F.col("_upto") < wanted) | (F.col("_values") > MAX_EXACT_ROWS)
    again = sorted(r["_m"] for r in of.where(missed).select("_m").distinct().collect())  # at most one row a measure

    window = Window.partitionBy(*keys, "_m").orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = _same_group(counts, totals, [*keys, "_m"]).withColumn("_cum", F.sum("_c").over(window))
    pick = ranked.where((F.col("_cum") >= wanted) & F.col("_v").isNotNull() & ~F.col("_m").isin(again or [-1]))
    pick = pick.groupBy(*keys).agg(*[F.min(F.when(F.col("_m") == i, F.col("_v"))).cast(df.schema[c].dataType).alias(f"_q{i}") for i, c in enumerate(cols)])
    out = _with_group(state, pick, keys)
    for i in again:
        slow = quantile_disc(df, cols[i], keys, p, f"_slow{i}")
        out = _with_group(out, slow, keys).withColumn(f"_q{i}", F.col(f"_slow{i}"))
    return out.select(*keys, *[F.col(f"_a{j}").alias(_name(df, c)) for j, c in enumerate(also)], *[F.col(f"_q{i}").alias(n) for i, n in enumerate(names)])


def _with_group(state: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    if keys:
        return _same_group(state, found, keys, "left")
    return state.withColumn("_one", F.lit(1)).join(found.withColumn("_one", F.lit(1)), "_one", "left").drop("_one")


def _name(df: DataFrame, aggregate: Column) -> str:
    return df.select(aggregate).columns[0]


def quantile_disc(df: DataFrame, value: str, keys: Sequence[str] = (), p: float = 0.5,
                  alias: str | None = None, buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Exact quantile of one measure by narrowing value ranges; ``buckets=1`` sums over all distinct values of a group."""
    alias = alias or f"{value}_q"
    keys = list(keys)
    v = df.select(*keys, F.col(value).alias("_v")).filter(F.col("_v").isNotNull())
    if buckets > 1:
        return _grouped_quantile(v, keys, p, buckets, alias) if keys else _global_quantile(v, p, buckets, alias)
    comp = v.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*(keys or [F.lit(0)]))
    comp = comp.withColumn("_tot", F.sum("_n").over(group)).withColumn("_cum", F.sum("_n").over(group.orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    pick = comp.filter((F.col("_cum") >= F.col("_tot") * p) & ((F.col("_cum") - F.col("_n")) < F.col("_tot") * p))
    return pick.select(*keys, F.col("_v").alias(alias))


# ---- global case: iterative range refinement -------------------------------------------------------

# a final bucket at most this large is resolved exactly by one window over its distinct values
MAX_EXACT_ROWS = 2_000_000


def _same_group(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on the group keys; a null key is a group like any other."""
    right = b.select(*[F.col(k).alias(f"_g_{k}") for k in keys], *[c for c in b.columns if c not in keys])
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_g_{k}"))
    return a.join(right, match, how).drop(*[f"_g_{k}" for k in keys])


def _in_range(df: DataFrame, lo, hi) -> DataFrame:
    if lo is not None:
        df = df.filter(F.col("_v") > F.lit(lo))
    if hi is not None:
        df = df.filter(F.col("_v") <= F.lit(hi))
    return df


def _global_quantile(v: DataFrame, p: float, buckets: int, alias: str) -> DataFrame:
    """Exact global quantile: each round sketches the current value range, counts rows per bucket
    (at most ``buckets`` rows come back) and narrows the range to the bucket holding the rank, until
    that bucket is small or holds one value. Every round is two passes with partial aggregation; the
    only data on the driver are cut points and bucket counts."""
    tot = v.count()
    if tot == 0:
        return v.limit(0).select(F.col("_v").alias(alias))
    rank = p * tot
    lo = hi = None
    off = 0
    cuts_frac = [i / buckets for i in range(1, buckets)]
    size = tot
    while True:
        sub = _in_range(v, lo, hi)
        cuts = sub.agg(F.percentile_approx("_v", cuts_frac, 10000).alias("c")).first()["c"] or []
        cuts = [float(c) for c in cuts]
        arr = F.array(*[F.lit(c) for c in cuts]).cast("array<double>")
        per_b = (sub.select(F.size(F.filter(arr, lambda c: c < F.col("_v"))).alias("_b"), "_v")
                 .groupBy("_b").agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("mn"), F.max("_v").alias("mx"))
                 .collect())
        cum = off
        chosen = None
        for r in sorted(per_b, key=lambda r: r["_b"]):
            if cum + r["n"] >= rank:
                chosen = r
                break
            cum += r["n"]
        if chosen is None:  # cannot happen unless the data changed between passes
            break
        b = chosen["_b"]
        b_lo = cuts[b - 1] if b > 0 else lo
        b_hi = cuts[b] if b < len(cuts) else hi
        if chosen["mn"] == chosen["mx"]:
            return v.limit(1).select(F.lit(chosen["mn"]).cast(v.schema["_v"].dataType).alias(alias))
        lo, hi, off = b_lo, b_hi, cum
        if chosen["n"] <= MAX_EXACT_ROWS or chosen["n"] == size:  # small, or one value holds nearly all of it
            break
        size = chosen["n"]
    comp = _in_range(v, lo, hi).groupBy("_v").agg(F.count(F.lit(1)).alias("_n"))
    wv = Window.partitionBy(F.lit(0)).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    comp = comp.withColumn("_cum", F.lit(off) + F.sum("_n").over(wv))
    pick = comp.filter((F.col("_cum") >= F.lit(rank)) & ((F.col("_cum") - F.col("_n")) < F.lit(rank)))
    return pick.select(F.col("_v").alias(alias))


def _grouped_quantile(v: DataFrame, keys: list[str], p: float, buckets: int, alias: str) -> DataFrame:
    """Exact quantile per group by iterative range refinement.

    A per-group state table (value range, rank offset, total, resolved value) is small (one row per
    group) and checkpointed each round. Each round joins the rows with the state of the unresolved
    groups, sketches cut points per group, counts rows per (group, bucket) and narrows every group to
    the bucket holding its rank; a bucket with a single value resolves the group at once. Rounds stop
    when every remaining target bucket has at most ``MAX_EXACT_ROWS`` rows, so the final window never
    holds more than that per group.
    """
    from ..session import materialized

    vtype = v.schema["_v"].dataType
    fr = [i / buckets for i in range(1, buckets)]
    in_range = ((F.col("_lo").isNull() | (F.col("_v") > F.col("_lo")))
                & (F.col("_hi").isNull() | (F.col("_v") <= F.col("_hi"))))
    state = materialized(v.groupBy(*keys).agg(F.count(F.lit(1)).alias("_tot")).select(
        *keys, "_tot", F.lit(None).cast("double").alias("_lo"), F.lit(None).cast("double").alias("_hi"),
        F.lit(0).cast("long").alias("_off"), F.lit(None).cast(vtype).alias("_ans")))
    size = None
    while True:
        live = state.filter(F.col("_ans").isNull()).drop("_ans")
        sub = _same_group(v, live, keys).filter(in_range)
        cuts = sub.groupBy(*keys).agg(F.percentile_approx("_v", fr, 10000).cast("array<double>").alias("_cuts"))
        vb = _same_group(sub, cuts, keys).withColumn("_b", F.size(F.filter(F.col("_cuts"), lambda c: c < F.col("_v"))))
        per_b = vb.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_mn"),
                                            F.max("_v").alias("_mx"))
        per_b = _same_group(_same_group(per_b, live, keys), cuts, keys)
        w = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        per_b = per_b.withColumn("_cum", F.col("_off") + F.sum("_n").over(w))
        tgt = per_b.filter((F.col("_cum") >= F.col("_tot") * p) & ((F.col("_cum") - F.col("_n")) < F.col("_tot") * p))
        nxt = materialized(tgt.select(
            *keys, "_tot",
            F.when(F.col("_b") > 0, F.try_element_at("_cuts", F.col("_b"))).otherwise(F.col("_lo")).alias("_lo"),
            F.when(F.col("_b") < F.size("_cuts"), F.try_element_at("_cuts", F.col("_b") + 1))
             .otherwise(F.col("_hi")).alias("_hi"),
            (F.col("_cum") - F.col("_n")).alias("_off"),
            F.when(F.col("_mn") == F.col("_mx"), F.col("_mn")).cast(vtype).alias("_ans"),
            F.col("_n")))
        done = state.filter(F.col("_ans").isNotNull())
        state = materialized(done.unionByName(nxt.drop("_n")))
        biggest = nxt.filter(F.col("_ans").isNull()).agg(F.max("_n").alias("m")).first()["m"]
        if biggest is None or biggest <= MAX_EXACT_ROWS or biggest == size:  # small, or one value holds nearly all
            break
        size = biggest
    live = state.filter(F.col("_ans").isNull()).drop("_ans")
    comp = _same_group(v, live, keys).filter(in_range).groupBy(*keys, "_off", "_tot", "_v").agg(F.count(F.lit(1)).alias("_n"))
    wv = Window.partitionBy(*keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    comp = comp.withColumn("_cum", F.col("_off") + F.sum("_n").over(wv))
    pick = comp.filter((F.col("_cum") >= F.col("_tot") * p) & ((F.col("_cum") - F.col("_n")) < F.col("_tot") * p))
    resolved = state.filter(F.col("_ans").isNotNull()).select(*keys, F.col("_ans").alias(alias))
    return pick.select(*keys, F.col("_v").alias(alias)).unionByName(resolved)
