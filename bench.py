"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the data folder, ``BENCH_CPUS`` the number of local cores,
``BENCH_RUNS`` the timed runs per query after one warm-up (the median counts). The
whole call is timed: building the frame, any intermediate table, and a full write
to a sink that drops the rows.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from spendweave.session import local_session  # noqa: E402
from verification.queries import QUERIES  # noqa: E402

HEADLINE = [
    "unified_row_kpis",
    "unified_ads",
    "daily_platform_summary",
    "campaign_totals",
    "campaign_performance",
    "campaign_ranks_counted",
    "platform_summary",
    "weekly_trends",
    "video_funnel",
    "quality_analysis",
    "filter_facts",
    "filter_platform_facts",
    "kpi_totals",
    "panel_radar",
    "view_row_counts",
    "published_row_counts",
    "executive_insights",
    "recommendations",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "bench", **{"spark.ui.showConsoleProgress": "false"})
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "sum of median seconds per headline query",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
