"""Wall time of the headline queries.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8) choose input and
cores.  Every query runs once to warm up and then ``BENCH_RUNS`` times (default 1); the best run
counts.  Results are written to a sink that takes every row and keeps none.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "station_risk_days",
    "station_lags",
    "weather_lags_leads",
    "weather_lags_leads_fleet",
    "fill_missing_days_weather",
    "dedup_keep_last",
    "missing_dates",
    "gap_islands",
    "availability_by_location",
    "table_quality_report",
    "zscore_outliers",
    "feature_matrix",
    "feature_matrix_long",
    "feature_target_corr",
    "risk_classify",
    "upsert_weather",
    "upsert_prediction",
    "gap_fill_from_source",
    "weather_payload_daily",
    "gauge_html_table",
    "infer_batch",
    "catchup_run",
    "seasonal_regression",
    "stream_daily_rollup",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    keys = sys.argv[1:] or HEADLINE
    from thalweg.catalog import QUERIES
    from thalweg.session import local_session

    spark = local_session(cores=cpus, app="thalweg-bench")

    def once(key: str) -> float:
        start = time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for key in keys:
        once(key)
        seconds[key] = round(min(once(key) for _ in range(runs)), 3)
        print(f"{key:32s} {seconds[key]:8.3f}s", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
