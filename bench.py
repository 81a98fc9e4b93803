"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Every query
is run whole into the ``noop`` sink: once to warm up, then ``BENCH_RUNS`` times,
of which the fastest counts.
"""

from __future__ import annotations

import json
import os
import time

from larkmetric.plans.queries import QUERIES
from larkmetric.session import build_session

HEADLINE = [
    "campaign_report_all",
    "campaign_report_enriched",
    "report_with_spend",
    "enriched_events",
    "enriched_report",
    "mau_by_campaign",
    "dau_by_campaign",
    "installs_by_campaign",
    "revenue_by_campaign",
    "ad_rollup",
    "ad_rollup_periods",
    "channel_unify",
    "naver_stats_join",
    "unpivot_costs",
    "identity_map",
    "event_dedup",
    "cleansed_events",
    "challenge_mart",
    "store_mart",
    "funnel_all_periods",
    "ltv_accumulate",
    "ltv_stream",
    "latest_snapshot",
    "num_clean",
    "os_class_of_documents",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times[1:] or times), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
