"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   tables to read (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated query names (default: the headline list)
"""

from __future__ import annotations

import json
import os
import time

from check_queries import session
from workloads import QUERIES

HEADLINE = (
    "project_flow clean_all dedupe_first dedupe_none missing_median missing_mode outlier_cap quality_report "
    "overview describe_numeric numeric_summary categorical_summary value_counts unique_counts "
    "aggregate_single aggregate_many share_of_total pivot_summary top_n "
    "trend_daily trend_monthly_median trend_smoothed moving_average moving_average_by_series seasonal_additive "
    "corr_pearson corr_spearman corr_kendall group_comparison ttest_welch chi_square contribution_to_change "
    "histogram density_curve box_stats scatter_grid pair_grid rules allocation scenario "
    "micro_batches stream_totals stream_consume split_exact split_stratified cv_folds "
    "classification_metrics regression_metrics train_linear kmeans_sizes load_csv"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's compilers before the clock starts.
    QUERIES["aggregate_single"](spark, sf_dir).collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
