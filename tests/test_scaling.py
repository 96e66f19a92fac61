"""How inputs are dealt out to tasks, and which steps run once."""
import datetime as dt

from estatelens.plans import catalog
from estatelens.session import scratch_path, spread


def test_tasks_do_not_grow_with_the_table(spark):
    slots = spark.sparkContext.defaultParallelism
    dealt = spread(spark.range(100_000 * (slots + 3), numPartitions=1))
    assert dealt.rdd.getNumPartitions() == slots + 3
    assert spread(spark.range(10, numPartitions=1)).rdd.getNumPartitions() == slots
    assert spread(spark.range(1000, numPartitions=2), "id", rows=10).rdd.getNumPartitions() == max(slots, 100)


def test_lines_are_shuffled_once_and_narrow(spark, tmpdir_path):
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmpdir_path}/{name}.parquet")

    put("region", [(0, "ASIA")], "r_regionkey long, r_name string")
    put("nation", [(0, "NATION_0", 0)], "n_nationkey long, n_name string, n_regionkey long")
    put("supplier", [(1, 0)], "s_suppkey long, s_nationkey long")
    put("lineitem", [(o, 1, 1, n, 20.0, 1000.0 + n, 0.0, dt.datetime(2024, 1, n), "A") for o in range(5) for n in (1, 2, 3)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber long, l_quantity double, l_extendedprice double, l_discount double, l_shipdate timestamp_ntz, l_returnflag string")
    staged = catalog.REGISTRY["li_stg_listings"](spark, tmpdir_path)
    assert sorted((r["listing_id"], r["price"]) for r in staged.collect()) == [(o, 1003.0) for o in range(5)]
    exchanges = [line for line in staged._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 1 and "l_orderkey" in exchanges[0]


def test_a_task_sorts_a_bounded_number_of_lines(spark, tmpdir_path):
    """A task's sort of wide staging rows has to fit a small share of an executor's memory (1,000,000 lines spilled)."""
    slots = spark.sparkContext.defaultParallelism
    spark.createDataFrame([(0, "ASIA")], "r_regionkey long, r_name string").write.parquet(f"{tmpdir_path}/region.parquet")
    spark.createDataFrame([(0, "NATION_0", 0)], "n_nationkey long, n_name string, n_regionkey long").write.parquet(f"{tmpdir_path}/nation.parquet")
    spark.createDataFrame([(1, 0)], "s_suppkey long, s_nationkey long").write.parquet(f"{tmpdir_path}/supplier.parquet")
    spark.range(200_000 * (slots + 3)).selectExpr(
        "id AS l_orderkey", "1L AS l_partkey", "1L AS l_suppkey", "1L AS l_linenumber", "20D AS l_quantity", "1000D AS l_extendedprice",
        "0D AS l_discount", "timestamp_ntz'2024-01-01 00:00:00' AS l_shipdate", "'A' AS l_returnflag").write.parquet(f"{tmpdir_path}/lineitem.parquet")
    assert catalog.li_raw(spark, tmpdir_path).rdd.getNumPartitions() == slots + 3


def test_a_delivery_appended_twice_is_normalised_once(spark, monkeypatch):
    seen, append = [], catalog.batches.append_raw
    rows = spark.range(3).selectExpr("id", "timestamp_ntz'2024-01-31 10:00:00' AS date_collected", "'c' AS source_city")
    monkeypatch.setattr(catalog, "landing_rows", lambda s, d: rows)
    monkeypatch.setattr(catalog.batches, "append_raw", lambda df, path: (seen.append(df.inputFiles()), append(df, path)))
    assert sorted(r["id"] for r in catalog.REGISTRY["sink_raw_append"](spark, scratch_path(spark, "none")).collect()) == [0, 0, 1, 1, 2, 2]
    assert len(seen) == 2 and seen[0] and seen[0] == seen[1]
