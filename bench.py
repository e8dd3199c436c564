"""Time the headline queries once warm; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from labwatch.catalog import QUERIES  # noqa: E402
from labwatch.session import build_session  # noqa: E402

HEADLINE = [
    "A01_positivity_by_month",
    "A19_one_hot",
    "C05_combined",
    "F01_normalize_text",
    "J03_interval_join",
    "J05_either_key",
    "L02_sabin",
    "L03_fleury",
    "M02h_week",
    "M04_week_states",
    "M08h_six_pathogens",
    "M11ch_cities_map",
    "M21_state_quality",
    "M22_against_estimates",
    "MALL_counts_by_lab",
    "Q20_kit_agrees",
    "Q24_suite",
    "S15_upsert",
    "W01_dedupe",
    "W04_propagate",
    "W06_drop_redundant",
    "W09_collapse_samples",
    "X06_weekly_counts_batch",
    "MCUBE_week_from_cube",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        seconds = []
        for _ in range(runs):
            start = time.perf_counter()
            # The noop sink runs the whole plan without collecting it.
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        times[name] = round(statistics.median(seconds), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        ),
        flush=True,
    )


if __name__ == "__main__":
    main()
