"""Benchmark: one JSON line with seconds per headline query.

Environment: ``BENCH_SF_DIR`` (tables), ``BENCH_CPUS`` (local cores), ``BENCH_RUNS``
(timed runs per query, the median counts), ``BENCH_QUERIES`` (comma list, or ``all``).
Every result is computed in full and discarded by the no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from ratelake.queries import QUERIES
from ratelake.session import local_session

HEADLINE = [
    "xml_observations",
    "range_read",
    "series_outer_merge",
    "series_pivot_merge",
    "forward_fill",
    "forward_fill_long",
    "prepare_rates",
    "dedupe_first",
    "clean_dedupe",
    "clean_impute",
    "decimal_comma",
    "date_parse",
    "write_append",
    "upsert_merge",
    "upsert_by_date",
    "delete_range",
    "stream_upsert",
    "feat_lags",
    "feat_rolling",
    "feat_scale_robust",
    "dq_outliers_iqr",
    "regression_metrics",
    "perf_over_time",
    "drift_psi",
    "ingest_run",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = sorted(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=8, app="ratelake-bench")
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        begun = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begun

    # One untimed query: class loading and the first file listing are not the engine.
    once("regression_metrics")
    seconds = {}
    for name in names:
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
