"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs to completion into the no-op sink (the whole plan executes, nothing is collected).
Queries over the lineitem adapter give the big inputs (600k scrapes over seven years at sf0.1);
the events adapter feeds the gate, history, normalisation and linkage jobs.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from estatelens.plans import catalog, marts, star  # noqa: E402
from estatelens.session import build_session  # noqa: E402

def li_district_summary(s, d):
    stg = catalog.li_stg(s, d)
    return marts.district_summary(star.fact(stg), star.dim_district(stg))


BENCH = {
    "li_stg_listings": catalog.REGISTRY["li_stg_listings"],
    "li_market_trends": catalog.REGISTRY["li_market_trends"],
    "li_city_summary": catalog.REGISTRY["li_city_summary"],
    "li_price_statistics": catalog.REGISTRY["li_price_statistics"],
    "li_district_summary": li_district_summary,
    "mart_market_trends": catalog.REGISTRY["mart_market_trends"],
    "dq_batch_verdict": catalog.REGISTRY["dq_batch_verdict"],
    "dq_report": catalog.REGISTRY["dq_report"],
    "snap_scd2_history": catalog.REGISTRY["snap_scd2_history"],
    "dedup_last_wins": catalog.REGISTRY["dedup_last_wins"],
    "link_match": catalog.REGISTRY["link_match"],
    "chk_summary": catalog.REGISTRY["chk_summary"],
}


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    only = set(sys.argv[1:])
    spark = build_session()
    # warm-up: JVM class loading and the first parquet footer reads are not query time
    spark.read.parquet(f"{sf_dir}/nation.parquet").write.format("noop").mode("overwrite").save()
    cold, warm = {}, {}
    for name, fn in BENCH.items():
        if only and name not in only:
            continue
        for runs in (cold, warm):  # first run pays plan compilation and JIT; the second is steady state
            t0 = time.time()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds_warm", "value": round(sum(warm.values()), 3), "unit": "sec",
                      "queries": warm, "cold_queries": cold, "cold_total": round(sum(cold.values()), 3),
                      "sf": sf, "cpus": os.environ.get("BENCH_CPUS", "8")}))


if __name__ == "__main__":
    main()
