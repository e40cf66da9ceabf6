"""Time the headline queries (median of three warm runs) and whole jobs (one warm run), one JSON line on stdout."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hydrolens import catalog  # noqa: E402
from hydrolens.session import get_session  # noqa: E402

HEADLINES = [
    "coverage_series",
    "confidence_histogram",
    "daily_summary",
    "correlation_series",
    "monthly_coverage_statistics",
    "uptime_filled",
    "outliers",
    "latest_predictions",
    "alert_counts",
    "change_rate",
    "weekly_returns",
    "monthly_price_statistics",
    "moving_averages",
    "gaps",
    "top_volume_days",
    "latest_objects",
    "upload_locations",
    "upserted_prices",
    "prediction_statistics",
    "evaluate_images",
    "evaluate_batches",
    "scored_by_plugin",
]

# Whole jobs: streams, stored objects and chunks. One warm-up and one timed run each.
JOBS = ["stream_scoring", "folder_scoring", "published_folder", "deduplicated_messages", "compacted_chunks"]


def warm(spark, folder: str) -> None:
    """Code paths that every query uses, so that the first query does not pay for the session."""
    for name in HEADLINES[:4]:
        for _ in range(2):
            catalog.queries()[name](spark, folder).write.format("noop").mode("overwrite").save()


def run(spark, folder: str, names: list[str], rounds: int = 3) -> dict[str, float]:
    times = {}
    warm(spark, folder)
    for name in names:
        query, taken = catalog.queries()[name], []
        for _ in range((1 if name in JOBS else rounds) + 1):
            begin = time.perf_counter()
            query(spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - begin)
        times[name] = round(statistics.median(taken[1:]), 3)  # the first run warms up
    return times


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "7g"})
    spark.sparkContext.setLogLevel("ERROR")
    times = run(spark, folder, sys.argv[1:] or HEADLINES + JOBS)
    spark.stop()
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline queries and jobs, total of warm medians", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": float(scale) if scale.replace(".", "").isdigit() else scale}))


if __name__ == "__main__":
    main()
