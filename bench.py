"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set).  Each query is run
twice (cold, warm) end to end - building the plan, its checkpoint jobs and
executing it into Spark's ``noop`` sink (the whole plan runs, no rows are
shipped to Python) - and the warm time is reported.  Before timing, every
query runs once on the sf0.001 tables (BENCH_WARMUP_DIR) so JVM code
generation and JIT warm-up do not land on whichever query happens to be first.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stratum.plans.queries import queries  # noqa: E402
from stratum.session import get_spark  # noqa: E402

HEADLINE = ["q12_hierarchical_rake", "q21_adjust_after_first", "q22_round_to_total", "q27_annual_series",
            "q25_assemble_inner", "q30_scenarios"]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    spark = get_spark(f"local[{cpus}]", "stratum-bench", shuffle_partitions=cpus,
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    qs = queries()
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if warm_dir and os.path.isdir(warm_dir):
        for name in names:
            qs[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times, cold, rows = {}, {}, {}
    for name in names:
        runs = []
        for _ in range(2):
            t0 = time.time()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - t0)
        rows[name] = qs[name](spark, sf_dir).count()
        cold[name], times[name] = round(runs[0], 3), round(runs[1], 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total_warm", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "cold": cold, "rows": rows, "sf": sf,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
