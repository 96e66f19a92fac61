"""A declared suite counts what each test's own query finds, in one aggregate per model."""
from estatelens.operators import checks as C
from estatelens.plans import assertions

D = C.Declared


def test_every_kind_with_planted_failures(spark):
    child = spark.createDataFrame([(1, "a", 5, "x"), (1, "b", None, "y"), (2, None, 7, "z"), (3, "a", 9, "x"), (None, "q", 9, None), (3, "a", 9, "x")], "k int, v string, fk int, w string")
    parent = spark.createDataFrame([(5,), (5,), (None,)], "pk int")
    models = {"child": child, "parent": parent}
    tests = [D("not_null", "child", ("v",)), D("not_null", "child", ("v",), where="k = 1"), D("unique", "child", ("k",)), D("unique", "child", ("fk",), severity="warn"),
             D("unique", "child", ("w",), where="k < 3"), D("unique_combination", "child", ("k", "v")), D("accepted_values", "child", ("v",), values=("a",)),
             D("relationships", "child", ("fk",), to="parent", field="pk"), D("relationships", "child", ("fk",), to="parent", field="pk", where="k = 2"),
             D("expression_is_true", "child", expression="k < 3"), D("by_hand", "child"), D("not_null", "missing", ("v",)), D("relationships", "child", ("fk",), to="missing", field="pk")]
    got = C.run_declared(tests, models, {"by_hand": child.where("k = 3")}).collect()
    frames = [C.not_null(child, "v"), C.not_null(child, "v", "k = 1"), C.unique(child, "k"), C.unique(child, "fk"), C.unique(child, "w", "k < 3"), C.unique_combination(child, ["k", "v"]),
              C.accepted_values(child, "v", ["a"]), C.relationships(child, "fk", parent, "pk"), C.relationships(child, "fk", parent, "pk", "k = 2"), C.expression_is_true(child, "k < 3"), child.where("k = 3")]
    want = [(t.name, t.column, f.count()) for t, f in zip(tests, frames)]
    assert sorted(map(str, want)) == sorted(str((r["check_name"], r["column_name"], r["failures"])) for r in got)
    assert [n for _, _, n in want] == [1, 0, 2, 1, 0, 1, 2, 4, 1, 3, 2]
    assert {r["status"] for r in got if r["severity"] == "warn"} == {"warn"} and "fail" in {r["status"] for r in got}


def test_all_declared_tests_are_there():
    tests = assertions.declared()
    assert len(tests) == 79 and len(set(tests)) == 79
    assert sum(t.name == "not_null" for t in tests) == 50 and sum(t.name == "relationships" for t in tests) == 8


def test_accepted_values_judges_the_staged_listings(spark, monkeypatch):
    from estatelens.plans import catalog

    staged = spark.createDataFrame([("primary",), ("rental",), ("rental",), (None,), ("secondary",)], "market_type string")
    monkeypatch.setattr(catalog, "stg", lambda s, d: staged)
    assert [tuple(r) for r in catalog.REGISTRY["chk_accepted_values"](spark, "none").collect()] == [("rental", 2)]


def test_unique_combo_judges_the_district_mart(spark, monkeypatch):
    from estatelens.plans import catalog

    mart = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("b", "x")], "city string, district string")
    staged = spark.createDataFrame([], "listing_id long")
    monkeypatch.setattr(catalog, "stg", lambda s, d: staged)
    monkeypatch.setattr(catalog.star, "fact", lambda s: s)
    monkeypatch.setattr(catalog.star, "dim_district", lambda s: s)
    monkeypatch.setattr(catalog.marts, "district_summary", lambda f, dd: mart)
    assert [tuple(r) for r in catalog.REGISTRY["chk_unique_combo"](spark, "none").collect()] == [("a", "x", 2)]
