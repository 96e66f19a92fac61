"""Secret scans by character Markov models.

Base spans are the matches of fixed formats that pass their checks. Beside them, every token of ``MIN_CHARS`` or more
key characters is scored by two first-order Markov models of characters: one of random strings, learnt from the values
that base spans hold, as they are and in upper and lower case, and one of ordinary identifiers, learnt from the tokens outside base spans. The score is the mean
log-likelihood ratio per transition. Tokens above ``LIMIT`` that overlap no base span become spans of kind ``random``.

Secrets without a format stand among the tokens outside base spans, so the identifier model is learnt in ``TURNS`` turns:
each leaves out the tokens above the limit by the turn before. A token that was learnt from is judged there with its own
transitions taken out of the counts (one of each), else its model would call it ordinary because it holds it. The limit
is a fixed ratio, so the number of secrets in a corpus does not move it.

Texts are scanned once, in column expressions; the models are counts of at most 128 x 128 transitions, summed over all
distinct labelled strings.

Edge cases: a null text counts as empty and has no spans; repeated rows are judged each and repeated strings count
once; with no base span to learn from, only base spans are returned; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, text_of
from .spans import apart, kept, matches, ordered, written

KINDS = ("assign", "access", "hex")
ALL_KINDS = (*KINDS, "random")
MIN_CHARS = 16
LIMIT = 0.0  # a token that the model of random strings explains better
TURNS = 5
SMOOTHING = 0.5
CODES = 128

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]++"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"
TOKEN = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{MIN_CHARS},}}+"


def _scanned(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    t, none = F.col("_t"), F.array().cast("array<struct<s:int,e:int,m:string>>")
    base = {"assign": F.when(t.rlike(ASSIGN), kept(matches(t, ASSIGN, 2), lambda m: F.length(m) >= 8)).otherwise(none),
            "access": F.when(F.instr(t, "AKIA") > 0, kept(matches(t, ACCESS), lambda m: F.length(m) >= 16)).otherwise(none),
            "hex": F.when(t.rlike(HEX), matches(t, HEX)).otherwise(none)}
    rows = docs.select(F.col(id_col).alias("id"), text_of(text).alias("_t"))
    found = rows.select("id", *[v.alias(f"_{k}") for k, v in base.items()], F.when(t.rlike(TOKEN), matches(t, TOKEN)).otherwise(none).alias("_tokens"))
    return staged(found.select("id", *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS], ordered({k: F.col(f"_{k}") for k in KINDS}).alias("base"),
                               F.concat(*[F.transform(f"_{k}", lambda x: x["m"]) for k in KINDS]).alias("values"), F.col("_tokens").alias("tokens")), "secret-spans")


def _steps(s: Column) -> Column:
    """Codes of the transitions of a string: previous character times ``CODES`` plus character."""
    code = lambda i: F.least(F.ascii(F.substring(s, i, F.lit(1))), F.lit(CODES - 1))
    return F.when(F.length(s) > 1, F.transform(F.sequence(F.lit(2), F.length(s)), lambda i: code(i - 1) * CODES + code(i)))


def _ratio(found: DataFrame) -> list[float] | None:
    """The log-likelihood ratio of each transition, or None without random or ordinary samples."""
    secret = found.select(F.explode("values").alias("s")).select(F.explode(F.array("s", F.upper("s"), F.lower("s"))).alias("s"), F.lit(1).alias("y"))
    plain = found.select("base", F.explode("tokens").alias("x")).where(apart(F.col("x"), F.col("base"))).select(F.col("x.m").alias("s"), F.lit(0).alias("y"))
    strings = staged(secret.union(plain).groupBy("s").agg(F.max("y").alias("y")).select("y", _steps(F.col("s")).alias("steps")), "secret-strings")
    random = _counted(strings.where("y = 1"))
    ordinary, learnt, table = strings.where("y = 0"), F.lit(True), None
    for _ in range(TURNS):
        counts = _counted(ordinary.where(learnt))
        if not random or not counts:
            return table
        table = _table(random, counts)
        learnt = _mean(F.col("steps"), F.size("steps"), F.when(learnt, _literal(_table(random, counts, 1))).otherwise(_literal(table))) <= LIMIT
        ordinary = staged(ordinary.select("steps", F.coalesce(learnt, F.lit(True)).alias("learnt")), "secret-ordinary")
        learnt = F.col("learnt")
    return table


def _counted(strings: DataFrame) -> dict[int, int]:
    return {r["step"]: r["count"] for r in strings.select(F.explode("steps").alias("step")).groupBy("step").count().collect()}  # at most 128 x 128 rows


def _table(random: dict[int, int], ordinary: dict[int, int], without: int = 0) -> list[float]:
    """Log-likelihood ratio of each transition; ``without`` ordinary samples of it."""
    def logs(n: dict[int, int], less: int) -> list[float]:
        out = []
        for a in range(CODES):
            row = [n.get(a * CODES + b, 0) for b in range(CODES)]
            total = max(0, sum(row) - less) + SMOOTHING * CODES
            out += [math.log((max(0, c - less) + SMOOTHING) / total) for c in row]
        return out

    return [round(y - x, 6) for y, x in zip(logs(random, 0), logs(ordinary, without))]


def _literal(table: list[float]) -> Column:
    return F.split(F.lit(" ".join(map(repr, table))), " ").cast("array<double>")  # folded to one literal


def _mean(steps: Column, n: Column, values: Column) -> Column:
    return F.aggregate(steps, F.lit(0.0), lambda a, step: a + F.element_at(values, step + 1)) / n


def detected(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, n_assign, n_access, n_hex, ``base`` and ``spans`` as arrays of (s, k, e) with k the
    place in ``ALL_KINDS``."""
    found = _scanned(docs, id_col, text)
    table, spans = _ratio(found), F.col("base")
    if table:
        values = _literal(table)
        more = F.filter("tokens", lambda x: apart(x, F.col("base")) & (_mean(_steps(x["m"]), F.length(x["m"]) - 1, values) > LIMIT))
        spans = F.sort_array(F.concat("base", F.transform(more, lambda x: F.struct(x["s"].alias("s"), F.lit(len(KINDS)).alias("k"), x["e"].alias("e")))))
    return found.select(F.col("id").alias(id_col), *[f"n_{k}" for k in KINDS], "base", spans.alias("spans"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return found.select(id_col, *[f"n_{k}" for k in KINDS], F.sha2(written(F.col("base"), ALL_KINDS).cast("binary"), 256).alias("base_sha256"), written(F.col("spans"), ALL_KINDS).alias("spans"))
