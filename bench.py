"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (no rows go to the
driver), once as warm-up and then $BENCH_REPEATS times; the median per query
is reported: over the driver's tables directly (the headline), then the load of the
model store, then over the store. Prints one JSON line:

{"metric": "total_median_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...,
 "load_sec": N, "on_store_sec": N, "on_store": {...}}
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.plans import store  # noqa: E402
from quarry.plans.registry import registry  # noqa: E402
from quarry.session import get_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    only = [p for p in os.environ.get("BENCH_ONLY", "").split(",") if p]
    spark = get_session(f"local[{cpus}]", app_name="quarry-bench",
                        shuffle_partitions=max(8, 2 * cpus),
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                               # Partition sizing for the bench scale: a few MB per task so
                               # every core works (a cluster keeps the 64-128 MB defaults).
                               "spark.sql.adaptive.advisoryPartitionSizeInBytes":
                                   os.environ.get("BENCH_ADVISORY_PARTITION", "4m"),
                               "spark.sql.files.maxPartitionBytes":
                                   os.environ.get("BENCH_MAX_PARTITION_BYTES", "8m")})
    queries = registry()
    if only:
        queries = {k: v for k, v in queries.items() if any(p in k for p in only)}

    def run(fn) -> float:
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    # JVM and code-generation warm-up on a representative join + aggregation.
    for key in ("epc_summary", "customer_report"):
        if key in queries:
            run(queries[key])

    def measured() -> dict[str, float]:
        out = {}
        for key, fn in queries.items():
            run(fn)
            out[key] = round(statistics.median(run(fn) for _ in range(repeats)), 4)
        return out

    # The queries over the driver's tables themselves, without a store.
    direct = measured()
    # Load: adapt the driver's tables once into the model store (the large joins run
    # here, once); the queries that follow read the store.
    t0 = time.perf_counter()
    for kind in ("era", "retail"):
        store.load(spark, sf_dir, kind)
    load_sec = round(time.perf_counter() - t0, 3)
    times = measured() if os.environ.get("BENCH_STORE", "1") != "0" else {}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_median_sec", "value": round(sum(direct.values()), 3), "unit": "sec",
           "queries": direct, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus, "repeats": repeats,
           "load_sec": load_sec, "on_store_sec": round(sum(times.values()), 3), "on_store": times}
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
