"""Write PLANS.md: physical plans of the headline queries (sf0.01), to show pushdown, pruning,
partial aggregation and the early top-1 limit."""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from estatelens.plans import catalog  # noqa: E402
from estatelens.session import build_session  # noqa: E402

KEYS = ["li_stg_listings", "li_market_trends", "dq_batch_verdict", "snap_scd2_history", "dedup_last_wins"]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    out = ["# Physical plans of headline queries\n",
           f"Generated by `scripts/plans.py` on `{sf}` (AQE initial plans; `isFinalPlan=false`).\n"]
    for k in KEYS:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            catalog.REGISTRY[k](spark, sf).explain("simple")
        out.append(f"\n## {k}\n\n```\n{buf.getvalue().strip()}\n```\n")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("".join(out))


if __name__ == "__main__":
    main()
