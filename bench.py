"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the timed
runs per query (the median is reported) and ``BENCH_QUERIES`` an optional comma-separated choice.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cohortry.session import build_session, release_scratch  # noqa: E402
from starcheck.queries import REGISTRY  # noqa: E402
from starcheck.scratch import ensure_scratch  # noqa: E402

HEADLINE = [
    "int_claims_unioned",
    "int_member_chronic_flags",
    "mart_member_risk_profile",
    "mart_care_gaps",
    "mart_cost_utilization",
    "readmission_flags",
    "primary_provider",
    "provider_top_condition",
    "mart_provider_efficiency",
    "code_range_join",
    "dq_duplicate_keys",
    "report_gap_heatmap",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = list(REGISTRY) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__showConsoleProgress="false",
    )
    ensure_scratch(spark).sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        started = time.perf_counter()
        # The no-op sink runs the whole query without moving its rows to the driver.
        REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds = {}
    for name in names:
        once(name)  # warm-up
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    release_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
