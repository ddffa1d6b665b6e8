"""Benchmark the headline queries (one per reference program) on one scale directory.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
Each query is executed completely with the ``noop`` sink (no collection to the driver), once
to warm up and then BENCH_RUNS times; the per-query figure is the median. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from prefkit.plans import queries as Q  # noqa: E402
from prefkit.session import local_session  # noqa: E402

HEADLINE = [
    "genre_avg_rating",  # average rating per genre
    "genre_top_items",  # five most-rated items per genre
    "genre_top_users",  # top users per genre with overall stats
    "item_column_summary",  # sparse-matrix column statistics
    "popular_items",  # popularity report
    "split_sizes",  # deterministic split
    "item_similarity",  # adjusted cosine against the target user's items
    "item_cf_recommend",  # neighbour-based top-50
    "als_evaluate",  # one ALS fit + validation error
    "als_grid_search",  # 8-model grid search with test error of the best
]


def run(spark, name, sf_dir):
    spark.catalog.clearCache()  # every run computes everything (cached small sides included)
    t0 = time.perf_counter()
    Q.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, app="prefkit-bench")
    results, errors = {}, {}
    for name in names:
        try:
            run(spark, name, sf_dir)  # warm-up
            times = [run(spark, name, sf_dir) for _ in range(runs)]
            results[name] = round(statistics.median(times), 3)
        except Exception as e:  # keep the one-line report even if a query fails
            errors[name] = f"{type(e).__name__}: {str(e).splitlines()[0][:200] if str(e) else ''}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "runs": runs,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
