"""Quality rules: fixed base rules, then robust multivariate outliers per language and source.

Each document becomes a vector of transformed text statistics. For every (language, source) a minimum-covariance-
determinant estimate is found by concentration steps: keep the ``CORE`` share of the group's documents that lie nearest
by Mahalanobis distance, re-estimate mean and covariance from them, repeat until the determinant falls no more. Each
group takes these steps from several fixed starts and keeps the one of the smallest determinant. The estimate of a
language is shrunk towards the one over all documents, that of a source towards its language's, with the weight of
``PRIOR_DOCS`` documents, so that a tiny group needs no case of its own. A document is rejected when its squared
distance passes the chi-square quantile.

Everything is column expressions and grouped aggregates: per step one quantile sketch and one moment sum per group and
start, for all groups and starts of a level at once, both combined on the map side, so a source with a third of all
documents costs no more than others. State and limits are one row per group and start in written tables. They are
broadcast behind a count of their rows, so that the points are not shuffled; beyond it they join by shuffle. The
steps end by themselves: one that goes on lowers the determinant, which the smallest deviations bound from below.

Edge cases: a null or empty text has no words and fails the base rules; null language or source is a group of its own;
repeated rows are judged alike; an empty table gives an empty result; extra columns are ignored by ``verdicts`` and kept
by ``keep``.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import small
from .common import group_key, let, pairs, staged, text_of, words_of

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
CORE = 0.75  # share of a group that a concentration step keeps
PRIOR_DOCS = 100.0
BROADCAST_ROWS = 50_000  # of at most 45 numbers each: larger tables of estimates join by shuffle
STILL = 0.01  # a start rests when a step lowers the logarithm of its determinant by less
TAIL = 1e-4  # chance that a normally distributed document is rejected

# (statistic, smallest standard deviation it is given): near-constant statistics must not reject single oddities
FEATURES = (("word_len", 0.12), ("symbols", 0.06), ("upper", 0.10), ("marks", 0.06), ("repeats", 0.15))
D = len(FEATURES)
MOMENTS = [f"m{i}" for i in range(D)] + [f"s{i}{j}" for i in range(D) for j in range(i + 1)]


def _chi2_cdf(x: float, k: int) -> float:
    a, x = k / 2, x / 2
    term = total = 1 / a
    n = 0
    while term > total * 1e-14:
        n += 1
        term *= x / (a + n)
        total += term
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def _chi2_quantile(p: float, k: int) -> float:
    low, high = 1e-9, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2_cdf(mid, k) < p else (low, mid)
    return low


CUTOFF = _chi2_quantile(1 - TAIL, D)
CONSISTENCY = CORE / _chi2_cdf(_chi2_quantile(CORE, D), D + 2)


def _repeat_words(words: Column, n: int = WINDOW) -> Column:
    """Words covered by n-word windows that occur twice or more in the text."""
    hashes = F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.xxhash64(F.slice(words, i, F.lit(n)))))

    def positions(ranked: Column) -> Column:
        same = pairs(ranked, lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))
        marked = let(same, lambda e: F.zip_with(ranked, F.zip_with(e, F.concat(F.array(F.lit(False)), e), lambda x, y: x | F.coalesce(y, F.lit(False))),
                                                lambda r, hit: F.when(hit, r["i"])))
        return F.sort_array(F.filter(marked, lambda x: x.isNotNull()))

    def covered(h: Column) -> Column:
        ranked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        spans = let(let(ranked, positions), lambda p: pairs(p, lambda a, b: F.least(F.lit(n), F.coalesce(b - a, F.lit(n)))))
        return F.aggregate(spans, F.lit(0).cast("long"), lambda s, x: s + x)

    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0).cast("long")))


def statistics(docs: DataFrame, keep: list[Column], text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Base statistics and the transformed vector x0..x4 of each row, beside the ``keep`` columns."""
    t = docs.select(*keep, text_of(text).alias("_t"), group_key(F.col(lang)).alias("_lang"), group_key(F.col(source)).alias("_source"))
    t = t.select("*", words_of(F.col("_t")).alias("_w"))
    out = lambda pattern: F.length("_t") - F.length(F.regexp_replace("_t", pattern, ""))
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    base = t.select(
        *[c for c in t.columns if c not in ("_t", "_w")],
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        out("[#*$%&|<>]").cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.coalesce(let(F.col("_w"), lambda w: _repeat_words(w)), F.lit(0)).cast("long").alias("n_repeat_words"),
        out("\\p{Lu}").alias("_upper"), out("[!?;:\"'()\\[\\]{}/_=~^]").alias("_marks"))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    count = F.greatest(F.col("n_words"), F.lit(1))
    vector = (F.log(chars / count), F.sqrt(F.col("n_symbols") / chars), F.sqrt(F.col("_upper") / chars), F.sqrt(F.col("_marks") / chars), F.sqrt(F.col("n_repeat_words") / count))
    return base.select(*[c for c in base.columns if c not in ("_upper", "_marks")],
                       ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"),
                       F.lit("all").alias("_all"), F.concat("_lang", F.lit("/"), "_source").alias("_site"),
                       *[v.cast("double").alias(f"x{i}") for i, v in enumerate(vector)])


def _factored(moments: DataFrame, *keys: str) -> DataFrame:
    """LDL' factors l_ij, d_i of the covariance s_ij, one column step per pivot."""
    for j in range(D):
        inner = lambda i, j=j: sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") * F.col(f"d{k}") for k in range(j)), F.lit(0.0))
        moments = moments.withColumn(f"d{j}", F.greatest(F.col(f"s{j}{j}") - inner(j), F.lit(FEATURES[j][1] ** 2 * 1e-2)))
        moments = moments.withColumns({f"l{i}{j}": (F.col(f"s{i}{j}") - inner(i)) / F.col(f"d{j}") for i in range(j + 1, D)})
    return moments.select(*keys, *MOMENTS,
                          *[f"d{i}" for i in range(D)], *[f"l{i}{j}" for i in range(D) for j in range(i)])


def _distance(rows: DataFrame) -> DataFrame:
    for i in range(D):
        rows = rows.withColumn(f"y{i}", F.col(f"x{i}") - F.col(f"m{i}") - sum((F.col(f"l{i}{k}") * F.col(f"y{k}") for k in range(i)), F.lit(0.0)))
    return rows.withColumn("distance", sum((F.col(f"y{i}") * F.col(f"y{i}") / F.col(f"d{i}") for i in range(D)), F.lit(0.0)))


def _step(points: DataFrame, state: DataFrame, side: Callable[[DataFrame], DataFrame], group: str, parent: DataFrame | None, above: str) -> DataFrame:
    """One concentration step of every start in ``state``: the estimate of the documents nearest to it. ``side`` marks a table
    of that many rows as the broadcast one of a join, if it is small."""
    near = _distance(points.select(group, *[f"x{i}" for i in range(D)]).join(side(state), group))
    cut = near.groupBy(group, "start").agg(F.percentile_approx("distance", CORE, 1000).alias("_cut"))
    bounds = staged(state.join(cut, [group, "start"]), "quality-bounds")
    core = _distance(points.select(group, *[f"x{i}" for i in range(D)]).join(side(bounds), group)).where(F.col("distance") <= F.col("_cut"))
    return _estimate(core, group, parent, above)


def _estimate(core: DataFrame, group: str, parent: DataFrame | None, above: str) -> DataFrame:
    """Mean and covariance of the rows of each (group, start), about the centre m they carry, shrunk towards the parent's."""
    off = lambda i: F.col(f"x{i}") - F.col(f"m{i}")
    m = core.groupBy(group, "start").agg(F.count(F.lit(1)).alias("_n"), F.first(f"up_{above}").alias(f"up_{above}"), *[F.first(f"m{i}").alias(f"c{i}") for i in range(D)],
                                         *[F.avg(off(i)).alias(f"e{i}") for i in range(D)], *[F.avg(off(i) * off(j)).alias(f"q{i}{j}") for i in range(D) for j in range(i + 1)])
    m = m.select(group, "start", "_n", f"up_{above}", *[(F.col(f"c{i}") + F.col(f"e{i}")).alias(f"m{i}") for i in range(D)],
                 *[(CONSISTENCY * (F.col(f"q{i}{j}") - F.col(f"e{i}") * F.col(f"e{j}")) + (FEATURES[i][1] ** 2 if i == j else 0.0)).alias(f"s{i}{j}") for i in range(D) for j in range(i + 1)])
    if parent is not None:
        m = m.join(parent.select(F.col(above).alias(f"up_{above}"), *[F.col(c).alias(f"p_{c}") for c in MOMENTS]), f"up_{above}")
        w = F.col("_n") / (F.col("_n") + PRIOR_DOCS)
        m = m.select(group, "start", f"up_{above}", *[(w * F.col(c) + (1 - w) * F.col(f"p_{c}")).alias(c) for c in MOMENTS])
    return _factored(m, group, "start", f"up_{above}").withColumn("log_det", sum((F.log(f"d{i}") for i in range(D)), F.lit(0.0)))


def _starts(points: DataFrame, group: str, parent: DataFrame | None, above: str) -> DataFrame:
    """The starts of each group: 0 its medians and quartile ranges, 1 its medians with the covariance of its parent (of all
    points about their medians, where there is none), 2 the parent's estimate."""
    quartiles = points.groupBy(group).agg(F.first(above).alias(f"up_{above}"), *[F.percentile_approx(f"x{i}", [0.25, 0.5, 0.75], 1000).alias(f"z{i}") for i in range(D)])
    spread = lambda i: (F.col(f"z{i}")[2] - F.col(f"z{i}")[0]) / 1.349
    own = staged(quartiles.select(group, f"up_{above}", F.lit(0).alias("start"), *[F.col(f"z{i}")[1].alias(f"m{i}") for i in range(D)],
                                  *[(F.pow(spread(i), 2) + FEATURES[i][1] ** 2 if i == j else F.lit(0.0)).alias(f"s{i}{j}") for i in range(D) for j in range(i + 1)]), "quality-starts")
    if parent is None:
        centred = own.select(group, f"up_{above}", F.lit(1).alias("start"), *[f"m{i}" for i in range(D)])
        rows = points.select(group, *[f"x{i}" for i in range(D)]).join(centred, group)
        shaped = [_estimate(rows, group, None, above).select(group, f"up_{above}", "start", *MOMENTS)]
    else:
        inherited = own.drop("start", *MOMENTS[D:]).join(parent.select(F.col(above).alias(f"up_{above}"), *MOMENTS[D:], *[F.col(f"m{i}").alias(f"p{i}") for i in range(D)]), f"up_{above}")
        shaped = [inherited.select(group, f"up_{above}", F.lit(k).alias("start"), *[F.col(f"{c}{i}").alias(f"m{i}") for i in range(D)], *MOMENTS[D:]) for k, c in ((1, "m"), (2, "p"))]
    out = own
    for more in shaped:
        out = out.unionByName(more)
    return _factored(out, group, "start", f"up_{above}").withColumn("log_det", F.lit(float("inf"))).withColumn("done", F.lit(False))


def _concentrated(points: DataFrame, group: str, parent: DataFrame | None = None, above: str = "_all") -> DataFrame:
    """The estimate of each group of ``group``, one row per group: every start takes concentration steps until its determinant
    falls by less than ``STILL``, and the start of the smallest determinant wins."""
    state = staged(_starts(points, group, parent, above), "quality-state")
    keys = [group, "start"]
    while rows := state.where(~F.col("done")).limit(BROADCAST_ROWS + 1).count():
        live = state.where(~F.col("done"))
        new = _step(points, live, F.broadcast if rows <= BROADCAST_ROWS else lambda t: t, group, parent, above)
        old = live.select(*keys, F.struct(*[c for c in live.columns if c not in keys]).alias("_old"))
        falls = F.col("log_det") < F.col("_old.log_det") - STILL
        better = F.col("log_det") < F.col("_old.log_det")
        taken = old.join(new, keys).select(*keys, *[F.when(better, F.col(c)).otherwise(F.col(f"_old.{c}")).alias(c) for c in new.columns if c not in keys], (~falls).alias("done"))
        state = staged(state.where("done").unionByName(taken), "quality-state")
    columns = [c for c in state.columns if c not in (group, "done", f"up_{above}")]
    best = state.groupBy(group).agg(F.min_by(F.struct(*columns), F.struct("log_det", "start")).alias("_b"))
    return staged(best.select(group, *[F.col(f"_b.{c}").alias(c) for c in columns]), "quality-estimate")


def estimates(stats: DataFrame) -> DataFrame:
    """The robust estimate of each (language, source), one row per group."""
    points = stats.where(~F.col("base_failed")).select("_all", "_lang", "_site", *[f"x{i}" for i in range(D)])
    everyone = _concentrated(points, "_all")
    language = _concentrated(points, "_lang", everyone, "_all")
    return _concentrated(points, "_site", language, "_lang")


def _judged(stats: DataFrame, states: DataFrame) -> DataFrame:
    rows = _distance(stats.join(small(states, BROADCAST_ROWS), "_site", "left"))
    # one CASE, not a conjunction: a filter on it is not split and pushed below the columns it is computed from
    return rows.withColumn("kept", F.when(F.col("base_failed"), False).otherwise(F.coalesce(F.col("distance") <= CUTOFF, F.lit(True))))


def verdicts(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, base statistics, ``base_failed``, ``distance`` (squared, Mahalanobis) and ``kept``."""
    stats = staged(statistics(docs, [F.col(id_col).alias("_id")]), "quality-stats")
    out = _judged(stats, estimates(stats))
    return out.select(F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def keep(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns. Rows are written once beside their statistics: texts are scanned
    once and never shuffled, the estimates read the narrow columns only, and the small table of them is joined to the rows."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    stats = staged(statistics(docs, [row]), "quality-rows")
    return _judged(stats, estimates(stats)).where("kept").select("_row.*")
