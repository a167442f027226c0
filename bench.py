"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]

Each query runs to completion through Spark's ``noop`` sink (no collection to
the driver); one untimed warm-up query starts the JVM and the Python workers.
Every query runs twice: ``queries`` holds the better (warm) time, ``cold``
the first run, which includes planning and code generation.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.plans import HEADLINE, QUERIES  # noqa: E402
from quarry.session import build_session  # noqa: E402


def main(argv: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = argv[1:] or list(HEADLINE)
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app="quarry-bench")
    # warm-up: JVM code generation and the Python workers of the NFKC step
    QUERIES["clean_chain"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(2):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(round(time.perf_counter() - t0, 3))
        cold[name], times[name] = runs[0], min(runs)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "cold": cold,
        "cold_total": round(sum(cold.values()), 3),
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main(sys.argv)
