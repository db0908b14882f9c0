"""Benchmark of the headline queries.

Runs each query over the generated tables at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints one JSON line. Every query is fully executed through the ``noop``
sink (no collection to the driver). Each query runs twice and the faster wall time is kept (the
first run also pays one-time costs of the session: JIT, per-folder checks of small tables).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "h5_build_features",
    "h8_engagement_30day",
    "f1_time_regularity",
    "f7_activity_regularity",
    "f10_procrastination",
    "f11_outcome_metrics",
    "e21_entropies",
    "e18_joint_distribution",
    "e3_effort",
    "e2_sequences",
    "c1_split_counts",
    "m14_threshold_f1",
    "m11_classification_metrics",
]


RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from coursepulse.plans.registry import load_all
    from coursepulse.session import get_spark

    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(cpus))
    reg = load_all()
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in reg]
    # warm-up: JVM start, parquet footers, code generation of the common scans
    for warm in ("a1_table_counts", "b5_drop_precourse"):
        reg[warm].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        best = None
        for _ in range(RUNS):
            t0 = time.perf_counter()
            reg[name].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            el = time.perf_counter() - t0
            best = el if best is None else min(best, el)
        times[name] = round(best, 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus), "runs": RUNS}))


if __name__ == "__main__":
    main()
