"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1) and ``BENCH_CPUS`` the cores.
Every query runs once to warm up and then ``BENCH_RUNS`` times; its time is the
median of those runs. Rows go to Spark's ``noop`` sink, so all columns are computed.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from retailweave.registry.queries import QUERIES  # noqa: E402
from retailweave.session import local_session  # noqa: E402

HEADLINE = (
    "warehouse",
    "cln_customers",
    "cln_transactions",
    "cln_articles",
    "cln_impute_median",
    "cln_impute_mode",
    "agg_exact_quantile_many_values",
    "lim_top_k",
    "jon_broadcast",
    "jon_shuffle",
    "jon_shuffle_hot_key",
    "jon_merge",
    "src_csv",
    "pip_load_historic",
    "pip_load_live",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session("bench", cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale[1]) if scale else sf_dir,
            }
        )
    )


if __name__ == "__main__":
    main()
