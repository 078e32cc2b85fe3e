"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Each query runs to the end with its rows thrown away, so nothing is collected.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession

HEADLINE = [
    "extract_links",
    "select_nodes_anchors",
    "page_titles",
    "embedded_articles",
    "json_listing",
    "parse_dates",
    "dedupe_first_valid",
    "dedupe_first_seen",
    "dedupe_first_dated",
    "merge_entries",
    "refresh_entries",
    "enrich_details",
    "pagination_frontier",
    "current_feeds",
    "feed_order_in_windows",
    "feed_order_in_slices",
    "render_feed",
    "audit_feeds",
    "inject_notices",
    "retire_feeds",
    "site_news_cards",
    "site_note_links",
    "site_time_articles",
    "site_front_page",
    "crawl_entries",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("feedloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        # The Python walk needs more tasks than the few bytes of a small test set suggest.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from feedloom.catalog import QUERIES

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    run("current_feeds")  # starts the JVM's and Python's workers
    seconds = {name: round(run(name), 3) for name in HEADLINE}
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )


if __name__ == "__main__":
    main()
