"""The command-line daily run over batches landed in the source's own layout (JSON array files), one of them cut off."""

from estatelens.__main__ import main
from estatelens.plans import catalog
from estatelens.sources import batches as B
from estatelens.sources.tables import TableStore

from .conftest import SF_SMALL


def test_cli_run_daily_over_array_files(spark, tmpdir_path):
    landing = tmpdir_path + "/landing"
    rows = catalog.landing_rows(spark, SF_SMALL)
    B.write_array_files(rows, landing)
    city = rows.select("source_city").orderBy("source_city").first()[0]
    spark.createDataFrame([('[{"id": 5, "title": "cu',)], "value string").write.mode("append").text(f"{landing}/source_city={city}/batch_date=2024-01-31")
    seed_path = tmpdir_path + "/seed"
    B.write_seed(catalog.lookup(spark, SF_SMALL), seed_path)
    code = main(["run-daily", "--landing", landing, "--store", tmpdir_path + "/wh", "--date", "2024-01-31",
                 "--seed", seed_path, "--layout", "arrays"])
    store = TableStore(spark, tmpdir_path + "/wh")
    verdict = {r["source_city"]: r for r in store.read("dq_verdict").collect()}
    assert len(verdict) == rows.select("source_city").distinct().count()
    assert verdict[city]["systemic_failure"] and verdict[city]["failed_rules"] == "unreadable_records(1)"
    assert B.read_raw(spark, store.root + "/raw_listings").filter(f"source_city = '{city}'").count() == 0
    results = store.read("check_results")
    assert results.count() == 79
    assert all(r["systemic_failure"] for r in verdict.values()) and code == 1  # planted gaps block every city here
