"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from apexlake.session import build_session
from apexlake.testbed.build import warehouse
from apexlake.testbed.registry import QUERIES

HEADLINE = [
    "int_results_qualifying", "int_driver_form", "int_driver_race", "int_teammate_qualifying",
    "dim_season", "dim_race", "dim_driver", "dim_constructor",
    "fct_race_results", "fct_points_by_round", "fct_driver_standings", "fct_driver_careers", "fct_driver_streaks",
    "fct_qualifying", "fct_lap_positions", "fct_pit_stops", "fct_teammate_qualifying",
    "check_A04", "check_A08", "check_A13", "check_A26", "dq_suite",
    "measure_R02", "measure_R18", "measure_R33",
    *[f"view_V{n:02d}" for n in range(1, 16)],
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = build_session(f"local[{cpus}]", cpus, **{"spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")})
    spark.sparkContext.setLogLevel("ERROR")

    seconds: dict[str, float] = {}

    def timed(name: str, action) -> None:
        started = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)

    # Test tables to landed pages, then pages to staging.
    timed("land_pages", lambda: dict(warehouse(spark, folder).raw))
    lake = warehouse(spark, folder)
    timed("stage_all", lambda: [lake.table(name) for name in lake.staged()])
    for name in HEADLINE:
        timed(name, lambda: QUERIES[name].run(spark, folder).write.format("noop").mode("overwrite").save())

    print(json.dumps({
        "metric": "total seconds of headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
