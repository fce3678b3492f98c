"""Benchmark the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_REPEAT (default 1; the median is reported),
BENCH_QUERIES (comma-separated subset). Each query is run to completion with
the ``noop`` sink, so every row is produced but nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "call_edges", "degree_ratios", "onehot_features", "kpi_summary", "tenure_risk",
    "triangle_count", "avg_clustering_directed", "neighbour_averages", "pagerank",
    "label_propagation", "connected_components", "graph_features", "pagerank_normalised",
    "combined_features", "diameter",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from churnlens.session import local_session
    from churnlens.plans.q_model import forget_written
    from churnlens.plans.queries import QUERIES

    spark = local_session(cpus, shuffle_partitions=max(8, int(cpus) * 2), app="churnlens-bench")
    # Warm-up: JVM, parquet footers, code paths (not timed).
    QUERIES["degree_features"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for n in names:
        runs = []
        for _ in range(repeat):
            forget_written()  # else a second run would only read what the first wrote
            t0 = time.perf_counter()
            df = QUERIES[n](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        timings[n] = round(statistics.median(runs), 3)
    out = {
        "metric": "headline_total_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(os.path.normpath(sf_dir)).replace("sf", ""),
        "cpus": int(cpus),
        "spark": spark.version,
    }
    print(json.dumps(out), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
