"""Reading the array layout: only the folders asked for are listed, a missing one is no rows."""

import os

from estatelens.sources import batches as B


def _plant(root, folder, ident):
    os.makedirs(f"{root}/{folder}")
    with open(f"{root}/{folder}/page.json", "w") as f:
        f.write('[{"id": %s, "date_collected": "2024-01-31T10:00:00Z"}]' % ident)


def test_array_layout_opens_only_the_folders_asked_for(spark, tmpdir_path):
    _plant(tmpdir_path, "katowice/2024-01-31", "1")
    _plant(tmpdir_path, "katowice/2024-02-01", "2")
    _plant(tmpdir_path, "source_city=opole/batch_date=2024-01-31", "3")
    _plant(tmpdir_path, "gdynia/2024-01-31", "4")

    def read(**asked):
        return B.read_batches(spark, tmpdir_path, layout="arrays", **asked)

    def seen(df):
        return sorted((str(r["id"]), r["source_city"], str(r["batch_date"])) for r in df.collect())

    assert len(seen(read())) == 4
    both = read(cities=["katowice", "opole", "nowhere"], day="2024-01-31")
    assert seen(both) == [("1", "katowice", "2024-01-31"), ("3", "opole", "2024-01-31")]
    assert len(both.inputFiles()) == 2
    assert len(read(day="2024-01-31").inputFiles()) == 3
    assert len(read(cities=["katowice"]).inputFiles()) == 2
    for nothing in (read(cities=[]), read(cities=["nowhere"]), read(day="2025-01-01")):
        assert nothing.count() == 0
        assert nothing.dtypes == both.dtypes


def test_a_broken_file_blocks_its_batch_only(spark, tmpdir_path):
    """In both layouts: the city's good rows do not pass without the missing ones, the other city is untouched."""
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(i, "c1" if i < 3 else "c2") for i in range(6)], "id long, source_city string").withColumn("batch_date", F.lit("2024-01-31").cast("date"))
    B.write_array_files(rows, tmpdir_path + "/arrays", rows_per_file=2)
    B.write_landing(rows, tmpdir_path + "/lines")
    for root, layout in (("/arrays", "arrays"), ("/lines", "landing")):
        spark.createDataFrame([('[{"id": 9, "tit',)], "value string").write.mode("append").text(tmpdir_path + root + "/source_city=c1/batch_date=2024-01-31")
        got = B.load_batches(spark, tmpdir_path + root, layout=layout)
        assert sorted(r["id"] for r in got.rows.collect()) == [3, 4, 5] and "_corrupt_record" not in got.rows.columns
        assert {r["source_city"]: (r["rows"], r["corrupt_records"], r["readable"]) for r in got.status.collect()} == {"c1": (3, 1, False), "c2": (3, 0, True)}
    assert B.load_batches(spark, tmpdir_path + "/none").rows.count() == 0
