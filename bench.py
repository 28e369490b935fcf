"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8) select data and cores.
Every query is executed in full into a sink that discards its rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks.compare import session
from checks.queries import QUERIES

HEADLINE = (
    "buys_normalise",
    "filtered_buys",
    "tax_reduced_mva",
    "nonmed_price",
    "remove_outliers",
    "write_step1",
    "estimate_cascade",
    "carry_forward_geo",
    "smooth_both_channels",
    "smooth_history",
    "rewrite_history",
    "manual_apply_geo",
    "rule_engine",
    "publish_monthly",
    "qc_funnel",
    "qc_price_validation",
    "monthly_prices",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(int(os.environ.get("BENCH_CPUS", "8")))
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()  # start the executors
    seconds = {}
    for key in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[key].spark(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[key] = round(time.perf_counter() - start, 3)
        print(f"{key:28} {seconds[key]:8.2f}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({
        "metric": "headline queries, total time", "value": total, "unit": "sec", "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
