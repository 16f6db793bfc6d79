"""Headline queries, timed: prints one JSON line. BENCH_SF_DIR and BENCH_CPUS choose the data and the cores."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from stayline.plans.registry import JOBS, as_query  # noqa: E402
from stayline.session import local_session  # noqa: E402

HEADLINES = [
    "silver_counts",
    "reload_window",
    "health_report",
    "occupancy_total",
    "paid_partner_split",
    "production",
    "agent_attainment",
    "agent_by_property",
    "daily_occupancy_pivot",
    "same_month_by_year",
    "rate_vs_network",
    "guest_metrics",
    "stay_fact",
    "stay_pairs",
    "return_intervals",
    "post_stay_contacts",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    # one untimed query, so that the first timing is not that of the engine starting up
    as_query(JOBS["date_parts"])(spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINES:
        begun = time.perf_counter()
        as_query(JOBS[name])(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begun, 3)
    total = round(sum(seconds.values()), 3)
    scale = Path(folder).name.removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
