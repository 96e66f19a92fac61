"""Distributed exact median vs brute force, on skewed groups (one group a third of the rows, one value
repeated across most of it) and on a continuous spread."""

import numpy as np
from pyspark.sql import functions as F

from estatelens.operators.quantile import quantile_disc


def brute(values, p=0.5):
    v = np.sort(np.asarray(values))
    k = int(np.ceil(p * len(v))) - 1  # smallest value whose cumulative share reaches p
    return float(v[max(k, 0)])


def test_median_matches_brute_force_on_skewed_groups(spark):
    rng = np.random.default_rng(7)
    rows = []
    for g in range(6):
        n = 3000 if g == 0 else 300            # group 0 holds about a third of all rows
        vals = rng.normal(100 * g, 15, n).round(2)
        if g == 0:
            vals[: 2 * n // 3] = 42.0          # one value dominates the hot group
        if g == 5:
            vals[::7] = np.nan                 # nulls are skipped
        rows += [(g, float(x) if not np.isnan(x) else None) for x in vals]
    df = spark.createDataFrame(rows, "g int, x double").repartition(8)
    got = {r["g"]: r["m"] for r in quantile_disc(df, "x", ["g"], alias="m").collect()}
    for g in range(6):
        vals = [x for gg, x in rows if gg == g and x is not None]
        assert got[g] == brute(vals), g
    # global, and with the bucket refinement switched off
    allv = [x for _, x in rows if x is not None]
    assert quantile_disc(df, "x", alias="m").first()["m"] == brute(allv)
    assert quantile_disc(df, "x", alias="m", buckets=1).first()["m"] == brute(allv)
    assert quantile_disc(df.filter(F.col("g") == 1), "x", alias="m", p=0.9).first()["m"] == \
        brute([x for gg, x in rows if gg == 1], 0.9)


def test_global_median_multi_round_refinement(spark, monkeypatch):
    """Force several refinement rounds (tiny exact threshold) and compare with brute force."""
    from estatelens.operators import quantile as Qm
    monkeypatch.setattr(Qm, "MAX_EXACT_ROWS", 20)
    rng = np.random.default_rng(11)
    vals = np.concatenate([rng.exponential(50, 4000).round(3), np.full(1500, 7.0)])
    df = spark.createDataFrame([(float(x),) for x in vals], "x double").repartition(8)
    for p in (0.5, 0.25, 0.9):
        assert quantile_disc(df, "x", alias="m", p=p, buckets=8).first()["m"] == brute(vals, p), p


def test_grouped_median_multi_round_refinement(spark, monkeypatch):
    from estatelens.operators import quantile as Qm
    monkeypatch.setattr(Qm, "MAX_EXACT_ROWS", 15)
    rng = np.random.default_rng(5)
    rows = []
    for g in range(4):
        n = 3000 if g == 0 else 400
        vals = rng.gamma(2.0, 30 + 10 * g, n).round(2)
        if g == 2:
            vals[:] = 9.5  # a single-valued group resolves at once
        rows += [(g, float(x)) for x in vals]
    df = spark.createDataFrame(rows, "g int, x double").repartition(8)
    for p in (0.5, 0.75):
        got = {r["g"]: r["m"] for r in quantile_disc(df, "x", ["g"], alias="m", p=p, buckets=8).collect()}
        assert got == {g: brute([x for gg, x in rows if gg == g], p) for g in range(4)}, p


def test_null_group_has_its_quantile(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 5.0), (None, 9.0), ("a", 2.0)], "g string, x double")
    got = {r["g"]: r["q"] for r in quantile_disc(df, "x", ["g"], alias="q").collect()}
    assert got == {None: 5.0, "a": 2.0}


def test_several_measures_in_two_passes(spark):
    """Null keys, groups without a value, ties, a hot group, long runs and NaN, with other aggregates beside."""
    import random

    from estatelens.operators.quantile import quantiles

    r = random.Random(5)
    rows = [("hot", r.random() * 1e6, float(i % 7)) for i in range(20_000)] + [(None, float(i % 3), None) for i in range(50)] + [("one", 4.0, 2.0), ("none", None, None)]
    rows += [("nan", float("nan"), 1.0), ("nan", 3.0, 1.0), ("nan", float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(5)
    for p in (0.0, 0.1, 0.5, 0.9, 1.0):
        got = {r["g"]: r for r in quantiles(df, {"qx": "x", "qy": "y"}, ["g"], p, also=[F.count(F.lit(1)).alias("n")]).collect()}
        for g in {r[0] for r in rows}:
            for k, c in ((1, "qx"), (2, "qy")):
                vals = sorted((v[k] for v in rows if v[0] == g and v[k] is not None), key=lambda v: (v != v, v))
                want = next((v for i, v in enumerate(vals, 1) if i >= p * len(vals)), None)
                assert repr(got[g][c]) == repr(want), (g, c, p)
            assert got[g]["n"] == sum(v[0] == g for v in rows)
    one = quantiles(df.where("g = 'hot'"), {"qx": "x", "qy": "y"}).first()
    assert one["qx"] == sorted(v[1] for v in rows if v[0] == "hot")[9_999] and one["qy"] == 3.0
    assert quantiles(df.limit(0), {"qx": "x"}, also=[F.count(F.lit(1)).alias("n")]).first().asDict() == {"n": 0, "qx": None}


def test_a_missed_bound_or_too_many_values_is_resolved_exactly(spark, monkeypatch):
    from estatelens.operators import quantile

    df = spark.range(5000).select((F.col("id") % 2).alias("g"), (F.col("id") * 7919 % 5000).cast("double").alias("x"))
    want = {g: sorted(i * 7919 % 5000 for i in range(g, 5000, 2))[1249] for g in (0, 1)}
    monkeypatch.setattr(quantile, "MAX_EXACT_ROWS", 10)
    assert {r["g"]: r["q"] for r in quantile.quantiles(df, {"q": "x"}, ["g"]).collect()} == want
    monkeypatch.undo()
    monkeypatch.setattr(quantile, "MARGIN", -0.1)  # bounds that enclose nothing
    assert {r["g"]: r["q"] for r in quantile.quantiles(df, {"q": "x"}, ["g"]).collect()} == want


def test_no_exchange_carries_raw_rows(spark):
    from estatelens.operators.quantile import quantiles

    df = spark.range(10_000).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("x"))
    plan = quantiles(df, {"q": "x"}, ["g"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Range (" not in plan  # what is left reads the written counts and bounds only
