"""Benchmark the headline queries.

Runs each query of ``HEADLINE`` on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]``: one warm-up run, then the
median of ``$BENCH_RUNS`` (default 3) timed runs (the queries of ``SLOW``: one run).  A run executes the whole
plan into Spark's ``noop`` sink, so nothing is collected to the driver.
Prints one JSON line, also when stopped by an interrupt; queries not begun within
``$BENCH_SECONDS`` (default 1600) are listed as skipped.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pizarra.plans.catalog import load_all  # noqa: E402
from pizarra.session import clean_scratch, get_session  # noqa: E402

HEADLINE = [
    "score_table",
    "pivot_mean",
    "reconcile",
    "describe",
    "ratings",
    "centred_ratings",
    "topk_per_user",
    "rating_averages",
    "ordered_split",
    "teachers_per_course",
    "standardise",
    "kruskal",
    "silhouette",
    "user_similarity",
    "course_similarity",
    "neighbour_features",
    "svd_recommend",
    "kmeans_scores",
    "dropout_scores",
    "gbt_ratings",
    "gbt_importance",
    "mlp_scores",
    "dropout_gbt",
    "elbow",
    "compare_k",
]

# Minutes long: timed once and without a warm-up run.
SLOW = {"gbt_ratings", "gbt_importance", "mlp_scores", "dropout_gbt", "elbow", "compare_k"}


def measure(spark, query, sf_dir: str, runs: int, warm_up: bool, times: dict, failed: list) -> None:
    name, samples = query.name, []
    try:
        for k in range(runs + warm_up):
            t0 = time.perf_counter()
            query.run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if k >= warm_up:
                samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    except Exception as exc:  # noqa: BLE001 - report and keep benchmarking the rest
        times[name] = None
        failed.append(name)
        print(f"# {name}: FAILED {type(exc).__name__}: {str(exc)[:200]}", file=sys.stderr, flush=True)
    clean_scratch(spark)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": str(int(cpus) * 2),
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
    })
    reg = load_all()
    times: dict[str, float | None] = {}
    failed: list[str] = []
    stop = time.perf_counter() + float(os.environ.get("BENCH_SECONDS", "1600"))
    try:
        for name in names:
            if time.perf_counter() > stop:
                break
            measure(spark, reg[name], sf_dir, 1 if name in SLOW else runs, name not in SLOW, times, failed)
    except KeyboardInterrupt:  # stopped from outside: report what there is
        pass
    skipped = [name for name in names if name not in times]
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(t for t in times.values() if t is not None), 3),
        "unit": "sec",
        "queries": times,
        "failed": failed,
        "skipped": skipped,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
