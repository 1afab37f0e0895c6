"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barloom.plans.registry import QUERIES
from barloom.session import build_session

HEADLINE = [
    "bars",
    "supplier_bars",
    "payload_flatten",
    "incremental_append",
    "size_capped",
    "calendar_fill",
    "interpolate",
    "returns",
    "supplier_returns",
    "indicator_panel",
    "supplier_panel",
    "accumulation_distribution",
    "hist_returns",
    "box_stats",
    "savgol",
    "supplier_savgol",
    "seasonal_decompose",
    "forecast_baseline",
    "forecast_additive",
    "forecast_vs_actual",
    "weekly_slice",
    "forecast_validation",
    "supplier_seasonal",
    "supplier_box_stats",
    "box_outliers",
    "stream_append",
    "period_table",
    "store_box_stats",
]
RUNS = 2


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["bars"](spark, folder).count()
    times = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        times[name] = round(best, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
