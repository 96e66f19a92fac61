"""The robust estimate: planted outliers against a numpy reference with many random starts, and the plan of one step."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from estatelens.llm import quality

D = quality.D


@pytest.fixture(scope="module")
def mixed(spark):
    r = np.random.default_rng(5)
    words = ["".join(r.choice(list("abcdefghijklmnoprstuvw"), r.integers(2, 10))) for _ in range(400)]
    plain = lambda n: " ".join(w.capitalize() if r.random() < 0.08 else w for w in r.choice(words, n)) + "."
    shout = lambda n: " ".join(w.upper() + "$$|" for w in r.choice(words, n))
    rows = [(i, shout(60) if i % 5 == 0 else plain(int(r.integers(40, 200))), "en" if i % 3 else None, f"s{i % 2}") for i in range(600)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)


@pytest.fixture(scope="module")
def points(mixed):
    stats = quality.statistics(mixed, [F.col("doc_id")])
    return stats.where(~F.col("base_failed"))


def _reference(x, starts):
    """Lowest log determinant that concentration steps with exact quantiles find from random small subsets."""
    floor, r, best = np.diag([f[1] ** 2 for f in quality.FEATURES]), np.random.default_rng(1), np.inf
    for _ in range(starts):
        part = x[r.choice(len(x), D + 3, replace=False)]
        m, s, last = part.mean(0), np.cov(part.T) + floor, np.inf
        while True:
            d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(s), x - m)
            core = x[d <= np.quantile(d, quality.CORE)]
            m, s = core.mean(0), quality.CONSISTENCY * np.cov(core.T, bias=True) + floor
            det = np.linalg.slogdet(s)[1]
            if det > last - 1e-9:
                break
            last = det
        best = min(best, last)
    return best


def test_determinant_is_the_smallest_of_many_starts(points):
    x = np.array([tuple(r) for r in points.select(*[f"x{i}" for i in range(D)]).collect()])
    own = quality._concentrated(points, "_all").first()
    assert abs(own["log_det"] - _reference(x, 40)) < 0.05
    s = np.array([[own[f"s{max(i, j)}{min(i, j)}"] for j in range(D)] for i in range(D)])
    assert abs(np.linalg.slogdet(s)[1] - own["log_det"]) < 1e-9


def test_planted_outliers_go_and_others_stay(mixed):
    kept = {r["doc_id"]: r["kept"] for r in quality.verdicts(mixed).collect()}
    assert len(kept) == 600
    assert not any(kept[i] for i in kept if i % 5 == 0)
    assert sum(not kept[i] for i in kept if i % 5) <= 2


def test_points_are_not_shuffled(spark, points):
    """Between the points and a step's grouped aggregates lies no exchange but the one after the partial aggregate; a state
    beyond the bound gives the same estimate by shuffle."""
    rows = quality.staged(points.select("_all", "_site", *[f"x{i}" for i in range(D)]), "quality-test")
    above = quality._concentrated(rows, "_all")
    state = quality.staged(quality._starts(rows, "_site", above, "_all"), "quality-test")
    by_size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        near = quality._distance(rows.join(F.broadcast(state), "_site")).groupBy("_site", "start").agg(F.percentile_approx("distance", 0.75, 1000))
        text = near._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in text and text.count("Exchange hashpartitioning") == 1
        key = lambda r: (r["_site"], r["start"])
        hinted, shuffled = (sorted(quality._step(rows, state, side, "_site", above, "_all").collect(), key=key) for side in (F.broadcast, lambda t: t))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", by_size)
    assert [key(r) for r in hinted] == [key(r) for r in shuffled] and len(hinted) > 3
    assert all(abs(a["log_det"] - b["log_det"]) < 0.1 for a, b in zip(hinted, shuffled))
