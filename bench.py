"""Time the headline queries: one warm-up, then the median of three runs each.

Past the time budget a query gets one run after its warm-up.

The corpus is one file of one row group, so it is dealt out to the threads.

Prints one JSON line. ``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the threads.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trackstats.plans.all_queries import QUERIES  # noqa: E402
from trackstats.plans.inputs import TEXT_PARTITIONS  # noqa: E402
from trackstats.session import session  # noqa: E402

BUDGET = 150.0

HEADLINE = [
    "artist_leaderboard_by_year",
    "clean_top_n_per_year", "keep_best_per_title", "top_300_per_year", "quality_report",
    "refresh_inner", "merge_full", "merge_reconciliation", "patch_columns",
    "feature_bounds", "yearly_and_all_time", "correlation_matrix", "band_filter",
    "kde_by_year", "ridgeline", "histogram", "nth_sample",
    "word_counts", "top_stems_per_year", "sentiment_scores", "text_metrics", "language_guess",
    "stream_layers", "html_table_rows",
]


def run(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = session(f"local[{cpus}]", app="bench", shuffle_partitions=int(cpus), **{
        "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false", TEXT_PARTITIONS: cpus})
    spark.sparkContext.setLogLevel("ERROR")
    times, runs, start = {}, {}, time.perf_counter()
    for name in names:
        run(QUERIES[name], spark, folder)
        runs[name] = 3 if time.perf_counter() - start < BUDGET else 1
        times[name] = round(statistics.median(run(QUERIES[name], spark, folder) for _ in range(runs[name])), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus), "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
