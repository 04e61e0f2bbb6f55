"""Benchmark: build the two-run warehouse, then run every registered query.

Prints one JSON line.  ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and
``BENCH_CPUS`` (default 8) select the data and ``local[N]``.  Each query is
executed in full with the ``noop`` sink (no driver collection).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tidewater.plans.queries import registry
    from tidewater.plans.scenario import warehouse
    from tidewater.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus),
                          extra={"spark.driver.memory": "16g"})
    times: dict[str, float] = {}
    spark.range(1000).selectExpr("sum(id)").collect()  # JVM warm-up, like session start
    t0 = time.time()
    warehouse(spark, sf_dir)
    times["etl_two_runs"] = round(time.time() - t0, 3)
    for name, fn in registry().items():
        t = time.time()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
    total = round(sum(times.values()), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_time_etl_and_queries", "value": total, "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else None}))
    spark.stop()


if __name__ == "__main__":
    main()
