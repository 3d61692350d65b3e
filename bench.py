"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).  Every
query is built and fully read.  Before, each runs once on the smallest scale
factor next to it, so that the time is not that of compiling the query.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "run_overview", "spectrum_summary", "precursor_charge_fractions", "rt_range", "ion_map",
    "rt_quantile_fractions", "tic_quantile_fractions", "max_frequency", "density_quantiles",
    "tic_change_ratios", "tic_quantile_ratios", "count_accessions", "group_psm_accessions",
    "ppm_summary", "psm_charge_fractions", "feature_charge_fractions", "extract_xic",
    "spikein_metrics", "scan_headers_asof", "headers_long", "pivot_properties", "pump_pressure",
    "track_calibrants", "decode_trace", "metric_table_long", "summary_table", "downsample_every_nth",
    "standardise_features", "pca_scores",
]


def main() -> None:
    from runlens.catalog.queries import QUERIES
    from runlens.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "bench")
    names = sys.argv[1:] or HEADLINE
    small_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")

    def run(name: str, directory: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    seconds = {}
    for name in names:
        if os.path.isdir(small_dir):
            run(name, small_dir)
        seconds[name] = run(name, sf_dir)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
