"""Nested items -> typed rows, on hand-built items (shapes of the source's sample items)."""

import json

from pyspark.sql import functions as F

from estatelens.operators import normalize as N


def generic(key, label, inner_key=None):
    v = {"__typename": "GenericParam", "key": inner_key or key}
    if label is not None:
        v["label"] = label
    return {"key": key, "value": v}


def price(value, currency="PLN"):
    return {"key": "price", "value": {"__typename": "PriceParam", "value": value, "currency": currency}}


FULL = {
    "id": 101, "title": "Flat", "url": "https://listings.example/ad/101", "created_time": "2026-07-01T10:00:00+02:00",
    "location": {"city": {"name": "Katowice"}, "district": {"name": "Centrum"}},
    "map": {"lat": 50.26, "lon": 19.02},
    "params": [price(391500.0), generic("m", "48,5 m²"), generic("rent", "650 zł"),
               generic("price_per_m", "8072 zł/m²"), generic("rooms", "2 pokoje"),
               generic("floor_select", "Parter"), generic("furniture", "Tak"), generic("market", "Wtórny"),
               generic("builttype", "Kamienica"),
               {"key": "odd", "value": {"__typename": "OtherParam", "label": "x"}}],
}
MINIMAL = {"id": 102, "title": "Only a title"}
DUPLICATES = {"id": 103, "params": [generic("m", "10 m²"), generic("m", "58 m²"), price(1.0), price(2.0, "EUR")]}
NO_LABEL = {"id": 104, "params": [generic("furniture", None), generic("market", "", inner_key="market")]}


def items_frame(spark, docs):
    rows = [("katowice", i, d if isinstance(d, str) else json.dumps(d, ensure_ascii=False)) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "source_city string, seq long, item_json string") \
        .withColumn("batch_date", F.lit("2026-07-01").cast("date"))


def typed(spark, docs):
    good, bad = N.split_malformed(items_frame(spark, docs))
    out = N.type_columns(N.params_to_columns(N.flatten_items(good)))
    return {r["id"]: r for r in out.collect()}, bad.count()


def test_full_item(spark):
    rows, _ = typed(spark, [FULL])
    r = rows[101]
    assert (r["price"], r["currency"], r["area_sqm"], r["extra_rent_pln"]) == (391500.0, "PLN", 48.5, 650.0)
    assert (r["num_rooms"], r["rooms_capped"], r["floor"], r["floor_capped"]) == (2, False, 0, False)
    assert (r["is_furnished"], r["market_type"], r["building_type"]) == (True, "secondary", "Kamienica")
    assert r["price_per_sqm_listed"] == 8072.0
    assert (r["city"], r["district"], r["latitude"], r["longitude"]) == ("Katowice", "Centrum", 50.26, 19.02)
    assert abs(r["price"] / r["area_sqm"] - r["price_per_sqm_listed"]) / r["price_per_sqm_listed"] < 0.05


def test_minimal_item(spark):
    rows, _ = typed(spark, [MINIMAL])
    r = rows[102]
    assert r["title"] == "Only a title" and r["price"] is None and r["area_sqm"] is None
    assert (r["num_rooms"], r["rooms_capped"], r["floor"], r["floor_capped"]) == (None, False, None, False)
    assert r["is_furnished"] is None and r["market_type"] is None and r["city"] is None


def test_later_params_win_and_unknown_kinds_ignored(spark):
    rows, _ = typed(spark, [DUPLICATES, FULL])
    assert rows[103]["area_sqm"] == 58.0
    assert (rows[103]["price"], rows[103]["currency"]) == (2.0, "EUR")


def test_missing_label_falls_back_to_key(spark):
    rows, _ = typed(spark, [NO_LABEL])
    # the label is empty, so the param's own key text is decoded: not 'tak' -> False, not a market -> null
    assert rows[104]["is_furnished"] is False and rows[104]["market_type"] is None


def test_malformed_items_are_skipped_and_counted(spark):
    docs = [FULL, '{"id": 7, "params": [', "[1, 2]", MINIMAL]
    rows, bad = typed(spark, docs)
    assert set(rows) == {101, 102} and bad == 2
    counts = N.malformed_counts(items_frame(spark, docs), ["source_city"]).first()
    assert (counts["items"], counts["malformed"]) == (4, 2)


def test_in_batch_dedup_last_wins(spark):
    first = dict(FULL, title="first")
    last = dict(FULL, title="last")
    out = N.normalize(items_frame(spark, [first, MINIMAL, last]), "2026-07-01 03:00:00")
    got = {r["id"]: r["title"] for r in out.collect()}
    assert got == {101: "last", 102: "Only a title"}
    assert str(out.first()["date_collected"]) == "2026-07-01 03:00:00"


def test_empty_object_is_an_item_and_wrong_shapes_are_malformed(spark):
    wrong = [dict(MINIMAL, location="Katowice"), dict(MINIMAL, params="m"), dict(MINIMAL, map=[1, 2]), dict(FULL, params=[1, 2])]
    docs = [{}, FULL, "null", "7", '"text"', "", '[{"id": 5}]', " \n" + json.dumps(MINIMAL), *wrong]
    good, bad = N.split_malformed(items_frame(spark, docs))
    assert sorted(str(r["id"]) for r in good.select("item.id").collect()) == ["101", "102", "None"]
    assert sorted(r["seq"] for r in bad.collect()) == [2, 3, 4, 5, 6, 8, 9, 10, 11]
    nothing = spark.createDataFrame([("katowice", 1, None)], "source_city string, seq long, item_json string")
    assert N.split_malformed(nothing)[1].count() == 1


def test_one_parse_a_row(spark):
    plan = N.normalize(items_frame(spark, [FULL]), "2026-07-01 03:00:00")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_no_generated_method_is_too_large_to_be_compiled(spark):
    """The JVM leaves methods of over 8000 bytes interpreted."""
    items = spark.createDataFrame([("katowice", "2024-01-31", 1, '{"id": 1, "params": []}')], "source_city string, batch_date string, seq long, item_json string").repartition(2)
    rows = N.normalize(items, "2024-01-31 10:00:00")
    assert rows.count() == 1 and len(rows.collect()) == 1
    plan = rows._jdf.queryExecution().executedPlan()
    parts = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$").codegenStringSeq(plan)
    sizes = [parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())]
    assert sizes and max(sizes) < 8000
