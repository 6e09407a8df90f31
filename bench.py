"""Benchmark: run every registered analog query over one scale-factor folder.

Prints ONE JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query is fully executed with the no-op sink (all rows produced, nothing
collected to the driver). Env: BENCH_SF_DIR (default /root/testdata/sf0.1),
BENCH_CPUS (default 8), BENCH_QUERIES (comma-separated prefixes, optional),
BENCH_WARMUP_DIR (default /root/testdata/sf0.001; empty to skip): every query
is first run once on that small folder so JVM and code-generation warm-up is
not timed; nothing computed there is reused by the timed run (other files).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [p for p in os.environ.get("BENCH_QUERIES", "").split(",") if p]

    from tidepool.plans.analogs import QUERIES
    from tidepool.session import get_session

    spark = get_session("tidepool-bench", master=f"local[{cpus}]", shuffle_partitions=cpus,
                        conf={"spark.driver.memory": "16g"})
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001").rstrip("/")
    names = [n for n in sorted(QUERIES) if not only or any(n.startswith(p) for p in only)]
    # Warm the JVM (code paths, parquet reader) outside the timings.
    spark.read.parquet(f"{sf_dir}/nation.parquet").write.format("noop").mode("overwrite").save()
    if warm_dir and os.path.isdir(warm_dir):
        for name in names:
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for name in names:
        spark.catalog.clearCache()  # nothing a former query kept is read again
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "warmup": warm_dir or None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
