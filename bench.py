"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (space-separated names, or "all").
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = (
    "mean_field_of_period field_scan partitioned_sink convert_units pending_units error_hints coverage_report "
    "daily_mean splice_sources mosaic regrid_bilinear anomaly moving_mean remove_preceding_mean lanczos_band_pass "
    "box_means despike divergence_vorticity precipitation_types upsert_forecasts lagged_ensemble_mean skill_score "
    "front_passages gram_matrix pattern_index oscillation_index map_items"
)


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from isopleth.plans import catalog
    from isopleth.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", HEADLINE).split()
    names = list(catalog.QUERIES) if chosen == ["all"] else chosen
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    catalog.QUERIES["daily_mean"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start-up cost
    times = {}
    for name in names:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
