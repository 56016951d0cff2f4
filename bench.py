"""Time the headline queries and print one JSON line.

Every query is written to the ``noop`` sink, so that all of its rows and columns are
computed: one warm-up, then the median of three runs. Streaming queries run twice.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pulsegrid import catalog
from pulsegrid.session import local_session

HEADLINE = (
    "risk_by_age", "age_stats", "risk_summary", "city_dist", "blood_risk", "top_conditions", "multi_condition",
    "overview", "recent_patients", "patient_card", "daily_report", "batch_saved",
    "dedup_readings", "latest_readings", "abnormal_patients", "alerts", "patients_monitored", "cycle_counts",
    "running_totals", "hourly_trend", "classify_vitals", "enriched_readings",
    "risk_change", "risk_profiles", "profile_patch_audit", "patched_profiles",
    "stream_ingest", "stream_alerts", "stream_cycle_counts", "stream_latest", "stream_latest_n", "stream_latest_n_table", "stream_risk_updates",
)


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, partitions=int(cpus), name="bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        repeats = 1 if name.startswith("stream") else 3
        run(spark, name, sf_dir)
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(repeats)), 3)
    print(json.dumps({
        "metric": "headline queries, total of medians",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
