"""Scaling on a replicated input: lineitem copied k times (distinct order keys per copy, many files),
the other tables as they are; the lineitem-adapter queries timed warm at each k.

usage: python scripts/scaling.py <scratch_dir> [k ...]      (default k = 1 4 16, from sf0.1)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from estatelens.plans import catalog  # noqa: E402
from estatelens.session import build_session  # noqa: E402

SRC = os.environ.get("SCALING_SRC", "/root/testdata/sf0.1")
QUERIES = ["li_stg_listings", "li_market_trends", "li_city_summary", "li_price_statistics"]


def build(spark, out: str, k: int) -> str:
    d = f"{out}/x{k}"
    if os.path.exists(f"{d}/lineitem.parquet/_SUCCESS"):
        return d
    for t in ["nation", "region", "supplier", "customer"]:
        spark.read.parquet(f"{SRC}/{t}.parquet").write.mode("overwrite").parquet(f"{d}/{t}.parquet")
    li = spark.read.parquet(f"{SRC}/lineitem.parquet")
    offset = li.agg(F.max("l_orderkey")).first()[0] + 1
    copies = spark.range(k).withColumnRenamed("id", "_copy")
    rep = li.crossJoin(F.broadcast(copies)) if k > 1 else li.withColumn("_copy", F.lit(0))
    rep = rep.withColumn("l_orderkey", F.col("l_orderkey") + F.col("_copy") * F.lit(offset)).drop("_copy")
    rep.repartition(8 * k).write.mode("overwrite").parquet(f"{d}/lineitem.parquet")
    return d


def main():
    out = sys.argv[1]
    ks = [int(x) for x in sys.argv[2:]] or [1, 4, 16]
    spark = build_session()
    for k in ks:
        d = build(spark, out, k)
        rows = spark.read.parquet(f"{d}/lineitem.parquet").count()
        times = {}
        for q in QUERIES:
            for _ in range(2):  # second run = warm
                t0 = time.time()
                catalog.REGISTRY[q](spark, d).write.format("noop").mode("overwrite").save()
                times[q] = round(time.time() - t0, 2)
        print(json.dumps({"replication": k, "lineitem_rows": rows, "warm_sec": times}), flush=True)


if __name__ == "__main__":
    main()
