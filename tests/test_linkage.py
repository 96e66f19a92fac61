"""Capture files in the three accepted shapes, candidate dedup and match outcomes."""

import json
import os

from pyspark.sql import functions as F

from estatelens.operators import linkage as L


def entry(cid, cname, rid, rname):
    return {"city": {"id": cid, "name": cname}, "region": {"id": rid, "name": rname}}


def test_read_and_link(spark, tmpdir_path):
    docs = {
        "a.json": json.dumps([entry(1, "Wałbrzych", 3, "Dolnośląskie"), entry(2, "Łódź", 7, "Łódzkie")]),
        "b.json": json.dumps({"data": [entry(1, "Walbrzych", 3, "dolnoslaskie"), entry(5, "Gliwice", 6, "Śląskie"),
                                       entry(6, "Gliwice", 6, "Śląskie"), entry(9, "Radom", None, "Mazowieckie")]}),
        "c.json": json.dumps(entry(8, "Opole", 12, "Lubuskie")),
        "d.json": "{not json",
        "e.json": json.dumps({"nothing": 1}),
    }
    for name, text in docs.items():
        with open(os.path.join(tmpdir_path, name), "w", encoding="utf-8") as f:
            f.write(text)
    entries = L.read_captures(spark, tmpdir_path)
    numbered = {r["doc"]: r["doc_id"] for r in L.read_capture_docs(spark, tmpdir_path).collect()}
    assert numbered == {text: k for k, (_, text) in enumerate(sorted(docs.items()), 1)}
    plan = L.read_capture_docs(spark, tmpdir_path)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]  # the documents' side of the join
    cands = L.candidates(entries)
    # (1, 3) appears twice: the first (file a) is kept; the entry without a region id is dropped
    kept = {(r["city_id"], r["region_id"]): (r["doc_id"], r["city_name"]) for r in cands.collect()}
    assert set(kept) == {(1, 3), (2, 7), (5, 6), (6, 6), (8, 12)}
    assert kept[(1, 3)][1] == "Wałbrzych"
    targets = spark.createDataFrame([
        ("walbrzych", "Wałbrzych", "dolnośląskie"), ("lodz", "Łódź", "łódzkie"), ("gliwice", "Gliwice", "śląskie"),
        ("opole", "Opole", "opolskie"), ("radom", "Radom", "mazowieckie")], "source_city string, city_name string, voivodeship string")
    m = {r["source_city"]: (r["status"], r["city_id"]) for r in L.link(targets, cands).collect()}
    assert m == {"walbrzych": ("OK", 1), "lodz": ("OK", 2), "gliwice": ("AMBIGUOUS", 5),
                 "opole": ("FALLBACK", 8), "radom": ("MISS", None)}
    rep = {r["status"]: r["targets"] for r in L.link_report(L.link(targets, cands)).collect()}
    assert rep == {"OK": 2, "AMBIGUOUS": 1, "FALLBACK": 1, "MISS": 1}
    cov = L.coverage(targets, L.location_ids(L.link(targets, cands))).filter(~F.col("mapped"))
    assert [r["source_city"] for r in cov.collect()] == ["radom"]
