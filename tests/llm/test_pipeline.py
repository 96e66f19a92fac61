"""corpus_pipeline.run against the chain of its stages, each judged by a plain rendering of what it must do."""
import numpy as np

import corpus_pipeline
from estatelens.llm import boilerplate, mixing, packing, quality, simhash


def test_run_equals_the_chain_of_stages(spark, tmp_path):
    r = np.random.default_rng(6)
    prose = lambda n: " ".join("w" + str(k) for k in r.integers(0, 900, n))
    copy = prose(60)
    texts = [prose(int(r.integers(30, 90))) + "\nAll rights reserved.\n" for _ in range(60)] + [copy] * 4 + [copy + " more"] + ["too short"] * 3 + [None, ""]
    rows = [(i, t, "en", f"s{i % 2}", None if t is None else len(t)) for i, t in enumerate(texts)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(2).write.parquet(path)
    docs = spark.read.parquet(path)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near dedup", "mix sources", "pack"]

    kept = quality.keep(docs)
    ids = {x["doc_id"] for x in kept.collect()}
    assert not ids & set(range(65, 70))  # short, null and empty documents go
    verdicts = {x["doc_id"]: x["kept"] for x in quality.verdicts(docs).collect()}
    assert ids == {i for i, k in verdicts.items() if k}
    cleaned = boilerplate.drop_lines(kept)
    assert all("All rights" not in x["text"] for x in cleaned.collect()) and {x["doc_id"] for x in cleaned.collect()} == ids
    one = simhash.keep_one(cleaned)
    components = {x["id"]: x["component"] for x in simhash.near_duplicates(cleaned).collect()}
    assert {x["doc_id"] for x in one.collect()} == set(components.values())
    mix = mixing.mixed(one)
    want = sorted((x["doc_id"], x["start"], x["length"], x["ids_crc32"], x["doc_tokens"]) for x in packing.packed(mix).collect())
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((x["doc_id"], x["start"], x["length"], x["ids_crc32"], x["doc_tokens"]) for x in got) == want
    # the mix takes documents of what is left only, and sequences are gapless
    assert {x["doc_id"] for x in got} <= set(components.values())
    by = {}
    for x in got:
        by.setdefault(x["sequence_id"], []).append((x["offset"], x["length"]))
    assert all(o == sum(length for p, length in v if p < o) for v in by.values() for o, _ in v)
