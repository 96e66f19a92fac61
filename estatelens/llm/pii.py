"""PII by candidate gradient boosting.

Base spans are the matches of fixed formats that pass their checks. Beside them, high-recall generators propose looser
and overlapping candidates: addresses with spelt-out signs, digit groups with other separators, numbers without the
sign that the base rules ask for. Boosted trees judge a candidate by its format and its context, and thresholds per kind
are calibrated on held-out candidates to a precision of ``PRECISION``; a kind that never reaches it adds nothing. A
selected candidate that overlaps a base span adds nothing either: base spans stay.

What the trees learn from: base spans are known to be personal data, so each is rewritten in its own context, into loose
forms that people write (positives) and into near misses of the same characters (negatives: a wrong check digit, digits
run together, a name without a domain, lists and dates). The generators run over the rewritten contexts, and whatever
they propose there is labelled. Candidates of the texts themselves that touch letters or fail their kind's format check
are further negatives; other unconfirmed candidates are what is to be judged and are not learnt from. All documents are
learnt from; one in ``HELD_OUT``, chosen by hash, only calibrates. Features are small whole numbers, so equal examples are
counted and the trees see each different one once, weighted by its count.

Texts are scanned twice, in column expressions, the second time for the rewritten contexts; only spans, features and
counts are written and joined.

Edge cases: a null text counts as empty and has no spans; repeated rows are judged each; with no confirmed span or no
negative to learn from, only base spans are returned; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, staged, text_of
from .spans import apart, kept, matches, ordered, written

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.98
HELD_OUT = 4  # one in so many documents calibrates
TREES, DEPTH = 10, 3

# Each pattern starts only where a run of its first characters starts or the match before ended: a start inside a run
# that failed fails as well, and long runs are read once. Possessive where what follows cannot use what is given back.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[ -]?[0-9]){11,}+"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"

GENERATORS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:@|[\[(]at[\])]) ?[A-Za-z0-9-]{1,64}+(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]{1,64}+){0,8}",
    "ip": r"(?<![0-9.,:])[0-9]{1,3}+(?: ?(?:[.,:]|[\[(](?:dot|\.)[\])]) ?[0-9]{1,3}+){3,7}",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ ./-]{0,2}[0-9]){11,18}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9])[+(]?[0-9](?:[ ().\/-]{0,3}[0-9]){6,14}(?![0-9])",
}
CONTEXT = {"reach": r"(?i)(?:tel|phone|call|fax|mobile|whatsapp)\W*$", "mail": r"(?i)(?:mail|contact|write|from|to)\W*$",
           "pay": r"(?i)(?:card|visa|credit|pay|account)\W*$", "net": r"(?i)(?:ip|host|server|address|addr)\W*$"}
FEATURES = ("kind", "chars", "digits", "letters", "blanks", "stops", "dashes", "brackets", "longest", "groups", "checks", "after_alnum", "before_alnum", "after_mark", *CONTEXT)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    def check(d: Column) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.length(d)), lambda i: let(F.substring(d, F.length(d) - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1), lambda v: F.when(v > 9, v - 9).otherwise(v)))
        return F.length(d).between(12, 19) & (F.aggregate(each, F.lit(0), lambda a, v: a + v) % 10 == 0)

    return let(_digits(m), lambda d: F.when(F.length(d).between(12, 19), check(d)).otherwise(False))


PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def _base(t: Column) -> dict[str, Column]:
    none = F.array().cast("array<struct<s:int,e:int,m:string>>")
    digits = t.rlike("[0-9]")
    return {
        "email": F.when(F.instr(t, "@") > 0, matches(t, EMAIL)).otherwise(none),
        "ip": F.when(digits, kept(matches(t, IP), lambda m: m.rlike(rf"^{PART}(?:\.{PART}){{3}}$"))).otherwise(none),
        "card": F.when(digits, kept(matches(t, CARD), _luhn)).otherwise(none),
        "phone": F.when(F.instr(t, "+") > 0, kept(matches(t, PHONE), lambda m: F.length(_digits(m)).between(9, 15))).otherwise(none),
    }


def _checks(m: Column, k: int) -> Column:
    """Whether a candidate of kind ``k`` has that kind's inner form, whatever its separators."""
    parts = F.array_remove(F.split(m, "[^0-9]+"), "")
    return (m.rlike(r"(?:\.|[\[(]dot[\])]) ?[A-Za-z]{2,}$"),
            (F.size(parts) == 4) & F.forall(parts, lambda x: x.rlike(f"^{PART}$")) & ~m.rlike("[,:]"),
            _luhn(m),
            F.length(_digits(m)).between(9, 15) & (F.size(parts) >= 3) & ~m.rlike(r"^(?:19|20)[0-9]{2}[-/.][01]?[0-9][-/.]"))[k]


def _features(t: Column, k: int, x: Column) -> Column:
    m = x["m"]
    left = F.substring(t, F.greatest(x["s"] - 23, F.lit(1)), F.least(x["s"], F.lit(24)))
    right = F.substring(t, x["e"] + 1, F.lit(1))
    of = lambda chars: F.length(m) - F.length(F.regexp_replace(m, chars, ""))
    parts = F.array_remove(F.split(m, "[^0-9]+"), "")
    longest = F.aggregate(parts, F.lit(0), lambda a, v: F.greatest(a, F.length(v)))
    values = (F.lit(k), F.length(m), of("[0-9]"), of("[A-Za-z]"), of(" "), of("[.]"), of("[-/]"), of("[()\\[\\]]"), longest, F.size(parts), _checks(m, k),
              right.rlike("[A-Za-z0-9]"), left.rlike("[A-Za-z0-9]$"), right.rlike("[,.;:!?]"), *[left.rlike(p) for p in CONTEXT.values()])
    return F.struct(F.lit(k).alias("k"), x["s"].alias("s"), x["e"].alias("e"), F.array(*[v.cast("double") for v in values]).alias("v"))


AFTER, BEFORE = FEATURES.index("after_alnum"), FEATURES.index("before_alnum")


def _rewritten(m: Column) -> dict[str, tuple[list[Column], list[Column]]]:
    """Loose forms and near misses of a confirmed span ``m`` of each kind."""
    name, host, digits = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1), _digits(m)
    spelt = lambda at, dot: F.concat(name, F.lit(at), F.replace(host, F.lit("."), F.lit(dot)))
    groups = lambda d, mark: F.regexp_replace(d, "([0-9]{4})(?=[0-9])", f"$1{mark}")
    wrong = F.concat(F.substring(digits, F.lit(1), F.length(digits) - 1), F.pmod(F.right(digits, F.lit(1)).cast("int") + 5, F.lit(10)).cast("string"))
    inner = F.regexp_replace(F.substring(m, F.lit(2), F.length(m)), r"^[^0-9(]+", "")
    mark = lambda c: F.regexp_replace(F.regexp_replace(inner, "[()]", ""), "[ .-]+", c)
    home = F.regexp_replace(m, r"^\+[0-9]{1,3}[ .-]+", "")  # without the country
    dotted = lambda c: F.replace(m, F.lit("."), F.lit(c))
    date = F.concat(F.lit("20"), F.substring(digits, 1, 2), F.lit("-0"), F.substring(digits, 3, 1), F.lit("-1"), F.substring(digits, 4, 1), F.lit(" 1"), F.substring(digits, 5, 1))
    return {
        "email": ([spelt("(at)", "."), spelt(" (at) ", "."), spelt(" [at] ", " [dot] "), spelt("[at]", "(dot)"), spelt(" @ ", ".")],
                  [F.concat(name, F.lit("@"), F.substring_index(host, ".", 1)), F.concat(name, F.lit(" (at) "), F.substring_index(host, ".", 1)), F.concat(name, F.lit("@"), digits)]),
        "ip": ([dotted("[.]"), dotted(" [dot] "), dotted("(dot)"), dotted(" . ")], [dotted(","), dotted(":"), dotted(", "), F.concat(F.lit("9"), dotted("00[.]"))]),
        "card": ([groups(digits, "."), groups(digits, "/"), groups(digits, " - "), groups(digits, "  ")], [groups(wrong, "."), groups(wrong, "/"), groups(wrong, " - "), wrong]),
        "phone": ([inner, mark("-"), mark("."), mark(" "), mark("/"), home, F.regexp_replace(F.regexp_replace(home, "[()]", ""), "[ .-]+", "-")], [digits, date, F.concat(F.substring(digits, 1, 3), F.lit(" "), F.substring(digits, 4, 3)), F.concat(F.substring(digits, 1, 4), F.lit("."), F.substring(digits, 5, 20))]),
    }


def _may(t: Column) -> Column:
    return t.rlike("[0-9@]|[\\[(]at[\\])]")


def _proposed(t: Column) -> Column:
    """What the generators propose in ``t``: structs of kind, start, end and features."""
    def of(k: int, pattern: str) -> Column:
        return F.transform(matches(t, pattern), lambda x: _features(t, k, x))

    return F.concat(*[of(k, p) for k, p in enumerate(GENERATORS.values())])


def _scanned(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    t = F.col("_t")
    rows = docs.select(F.col(id_col).alias("id"), text_of(text).alias("_t"), F.monotonically_increasing_id().alias("_row"))
    found = rows.select("id", "_row", "_t", *[v.alias(f"_{k}") for k, v in _base(t).items()])
    loose = F.when(_may(t), _proposed(t))
    return staged(found.select("id", "_row", *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
                               ordered({k: F.col(f"_{k}") for k in KINDS}).alias("base"), loose.alias("loose")), "pii-spans")


def _examples(found: DataFrame, docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """Labelled candidates of all documents: (held, k, features, label), and ``n`` times that each occurs."""
    from pyspark.ml.functions import array_to_vector

    t = F.col("_t")
    held = (F.pmod(F.xxhash64("id", F.lit(5)), F.lit(HELD_OUT)) == 0).alias("held")
    rows = docs.select(F.col(id_col).alias("id"), text_of(text).alias("_t")).select(held, "_t", *[v.alias(f"_{k}") for k, v in _base(F.col("_t")).items()])
    around = lambda x: (F.substring(t, F.greatest(x["s"] - 39, F.lit(1)), F.least(x["s"], F.lit(40))), F.substring(t, x["e"] + 1, F.lit(12)))

    def forms(kind: str) -> Column:
        def of(x: Column) -> Column:
            loose, missed = _rewritten(x["m"])[kind]
            left, right = around(x)
            return F.array(*[F.struct(F.concat(left, v, right).alias("t"), F.length(left).alias("s"), F.length(F.concat(left, v)).alias("e"), F.lit(KINDS.index(kind) if good else -1).alias("k"))
                             for good, some in ((True, loose), (False, missed)) for v in some])

        return F.transform(F.col(f"_{kind}"), of)

    each = F.flatten(F.concat(*[forms(kind) for kind in KINDS]))
    made = rows.select("held", F.explode(each).alias("f")).select("held", F.col("f.t").alias("_t"), F.col("f.s").alias("fs"), F.col("f.e").alias("fe"), F.col("f.k").alias("fk"))
    made = made.select("held", "fs", "fe", "fk", F.explode(_proposed(t)).alias("c")).select("held", "fs", "fe", "fk", "c.*").where((F.col("s") < F.col("fe")) & (F.col("fs") < F.col("e")))
    # a proposal that is the loose form, give or take an end, is a positive; one of another kind or a part of it is a negative
    hit = (F.col("k") == F.col("fk")) & (F.abs(F.col("s") - F.col("fs")) + F.abs(F.col("e") - F.col("fe")) <= 2)
    made = made.select("held", "k", "v", hit.cast("double").alias("label"))
    own = found.select(held, "base", F.explode("loose").alias("c")).select("held", "base", "c.*")
    against = (F.get("v", F.lit(FEATURES.index("checks"))) == 0) | (F.get("v", F.lit(AFTER)) == 1) | (F.get("v", F.lit(BEFORE)) == 1)
    own = own.where(apart(F.struct("s", "e"), F.col("base")) & against).select("held", "k", "v", F.lit(0.0).alias("label"))
    counted = made.unionByName(own).groupBy("held", "k", "v", "label").agg(F.count(F.lit(1)).cast("double").alias("n"))
    return staged(counted.select("held", "k", "label", "n", array_to_vector("v").alias("features")), "pii-examples")


def _model(examples: DataFrame):
    """The boosted trees and the threshold of each kind; None if there is nothing to learn."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import vector_to_array

    seen = {r["label"]: r["count"] for r in examples.where(~F.col("held")).groupBy("label").count().collect()}
    if len(seen) < 2:
        return None, {}
    bins = max(32, isqrt(sum(seen.values())) + 1)  # beyond the square of this number the learner takes split points from a sample
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=bins, seed=7, weightCol="n").fit(examples.where(~F.col("held")).select("features", "label", "n"))
    scored = model.transform(examples.where("held")).select("k", "label", "n", F.floor(vector_to_array("probability")[1] * 100).alias("bin"))
    bins = scored.groupBy("k", "bin").agg(F.sum(F.col("label") * F.col("n")).alias("hits"), F.sum("n").alias("n")).collect()  # at most 101 rows a kind
    limits = {}
    for k in range(len(KINDS)):
        hits = n = 0.0
        for r in sorted((r for r in bins if r["k"] == k), key=lambda r: -r["bin"]):
            hits, n = hits + r["hits"], n + r["n"]
            if r["bin"] >= 50 and hits >= PRECISION * n:
                limits[k] = r["bin"] / 100
    return model, limits


def detected(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, n_email, n_ip, n_card, n_phone, ``base`` and ``spans`` as arrays of (s, k, e) with k
    the place in ``KINDS``."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    found = _scanned(docs, id_col, text)
    each = found.where(F.size("loose") > 0).select("id", "_row", "base", F.explode("loose").alias("c")).select("id", "_row", "base", "c.*")
    free = apart(F.struct("s", "e"), F.col("base"))
    each = each.where(free).select("_row", "k", "s", "e", array_to_vector("v").alias("features"))
    model, limits = _model(_examples(found, docs, id_col, text))
    kinds = [f"n_{k}" for k in KINDS]
    if not limits:
        return found.select(F.col("id").alias(id_col), *kinds, "base", F.col("base").alias("spans"))
    limit = F.coalesce(*[F.when(F.col("k") == k, F.lit(v)) for k, v in limits.items()], F.lit(2.0))
    more = model.transform(each).where(vector_to_array("probability")[1] >= limit)
    more = more.groupBy("_row").agg(F.collect_set(F.struct("s", "k", "e")).alias("more"))
    spans = F.sort_array(F.concat("base", F.coalesce("more", F.array().cast("array<struct<s:int,k:int,e:int>>"))))
    return found.join(more, "_row", "left").select(F.col("id").alias(id_col), *kinds, "base", spans.alias("spans"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return found.select(id_col, *[f"n_{k}" for k in KINDS], F.sha2(written(F.col("base"), KINDS).cast("binary"), 256).alias("base_sha256"), written(F.col("spans"), KINDS).alias("spans"))
