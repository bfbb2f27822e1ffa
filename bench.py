"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

$BENCH_QUERIES names other queries (comma-separated), "all" runs every query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cadenza.session import build_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "schedule_strings", "short_strings", "condition_imputation", "first_per_key", "left_merge", "merged_table",
    "blacklist_anti", "parse_days", "split_units", "fuzzy_tfidf", "contains_fanout", "edit_distance_match",
    "match_status",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "")
    chosen = list(QUERIES) if names == "all" else [n for n in names.split(",") if n] or HEADLINE
    spark = build_session(
        "cadenza-bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Warm up with queries of the same kind on other data.
    small = os.environ.get("BENCH_WARMUP_DIR", os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001"))
    for name in ("schedule_strings", "fuzzy_tfidf"):
        QUERIES[name](spark, small).write.format("noop").mode("overwrite").save()
    spark.catalog.clearCache()
    seconds = {}
    for name in chosen:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
        spark.catalog.clearCache()
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
