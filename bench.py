"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default: all) choose data and cores. Every
query runs three times to a no-op sink; the figure is the median, which leaves out the cold first run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from siltstone.plans import registry
from siltstone.session import build_session

HEADLINE = (
    "mart_movie_popularity",
    "mart_user_activity",
    "mart_movie_rating",
    "mart_subscription_revenue",
    "fact_user_activity",
    "fact_movie_popularity",
    "dedup_latest",
    "merge_upsert",
    "merge_upsert_composite",
    "prep_taxi_trip",
    "weekend_night_trips",
    "zone_flow",
    "holiday_summary",
    "playback_alerts",
    "alert_digest",
    "events_parse_json",
    "page_links",
    "detail_fields",
    "biodata",
    "decision_extracts",
    "summary_topn",
    "loan_stats",
    "dq_not_null",
    "dq_unique",
    "dq_relationships",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=str(cpus) if cpus.isdigit() else "8",
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    known = registry.queries()
    seconds = {}
    for name in names:
        runs = []
        for _ in range(3):
            started = time.perf_counter()
            known[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(runs), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
