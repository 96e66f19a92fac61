"""Removal of windows of earlier documents against brute force."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from estatelens.llm import substrings

SCHEMA = "doc_id long, text string, id long, digest string, first int, row string, words string"
W = 13


def words_of(t):
    return (t or "").encode().split()


def brute(rows):
    least = {}
    for d, t in rows:
        w = words_of(t)
        for k in range(len(w) - W + 1):
            if d is not None:
                key = tuple(w[k:k + W])
                least[key] = min(least.get(key, d), d)
    out = []
    for d, t in rows:
        w = words_of(t)
        gone = {k + j for k in range(len(w) - W + 1) if d is not None and least[tuple(w[k:k + W])] < d for j in range(W)}
        out.append((d, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=str)


def corpus():
    r = np.random.default_rng(3)
    vocab = [f"w{k}é" for k in range(400)] + ["\x1cfs", "a\x85b", "c　d"]
    prose = lambda n: " ".join(r.choice(vocab, n))
    passage, copy = prose(60), prose(300)
    texts = [None, "", " \n\t", "one", prose(12), prose(13), prose(14)]
    texts += [prose(int(r.integers(5, 90))) + "\n" + passage + "\t " + prose(int(r.integers(0, 40))) for _ in range(30)]
    texts += [copy] * 25 + [copy + " more"] * 3 + [" ".join(copy.split()[5:200])]
    texts += [prose(20) + " of the" * 40, " of the" * 300, "the of " * 20, "x " * 500, "x " * 13, "y " * 12]
    texts += [f"of the {prose(2)} of the {prose(2)} " * 3 for _ in range(20)]
    texts += [prose(20_000), "z" * 200_000 + " " + passage]
    order = r.permutation(len(texts))
    rows = [(int(i) - 3, texts[i]) for i in order]
    return rows + [(7, copy), (7, copy), (7, passage + " other text"), (None, copy), (None, passage), (2, passage), (2, prose(30))]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.mark.parametrize("parts, bucket_chars, block_chars", [(1, 6_000_000, 8_000_000), (4, 3_000, 20_000), (7, 50_000, 1)])
def test_equals_brute_force(spark, rows, parts, bucket_chars, block_chars):
    df = spark.createDataFrame([(d, t, 1, "x", 2, "r", "w") for d, t in rows], SCHEMA).repartition(parts)
    got = substrings.cleaned(df, bucket_chars=bucket_chars, block_chars=block_chars)
    assert sorted(((r["row"]["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got.collect()), key=str) == brute(rows)
    assert got.select("row.id", "row.digest", "row.first", "row.words").distinct().collect() == [(1, "x", 2, "w")]


def test_any_sample_of_pairs_gives_the_same_rows(spark, rows, monkeypatch):
    """All pairs frequent, and none."""
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows)
    for hashes in (np.zeros(0, np.uint64), None):
        if hashes is None:
            words = sorted({w for _, t in rows for w in words_of(t)})
            h = substrings._hashes(substrings.pa.array(words))
            hashes = np.unique(np.concatenate([substrings._pairs(np.array([a, b], np.uint64)) for a in h[::2] for b in h[::2]]) >> np.uint64(1))
        monkeypatch.setattr(substrings, "_frequent_pairs", lambda *a, hashes=hashes: hashes)
        got = substrings.cleaned(df, bucket_chars=3000, block_chars=20_000)
        assert sorted(((r["row"]["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got.collect()), key=str) == want


def test_equal_hashes_of_different_words_are_told_apart():
    ids = np.array([1, 2, 3, 1, 2, 4, 1, 2, 3, 1, 2, 4])
    start = np.array([0, 3, 6, 9])
    same = substrings._classes(ids, start, np.full(4, 3), np.zeros(4, np.uint64))
    assert same.tolist() == [0, 1, 0, 1]


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert substrings.cleaned(empty).count() == 0
    nulls = spark.createDataFrame([(1, None), (None, None)], "doc_id long, text string")
    assert substrings.cleaned(nulls).agg(F.sum("n_words")).first()[0] == 0
