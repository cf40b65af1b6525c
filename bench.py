"""Headline queries at one scale; prints one JSON line.

Each query runs once to warm up and then three times; the median counts. Results
go to the noop sink, so that what is timed is the whole result and no driver
collect.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from exposura import catalog
from exposura.session import build_session

HEADLINE = [
    "flag_report", "keyword_flag", "flag_incremental", "unique_sparse", "dedup_files", "pii_scan", "redact",
    "line_clean", "strip_watermark", "strip_html", "extract_links", "watchlist_exposure", "exposure_report",
    "risk_score", "host_statistics", "forum_latest_run", "latest_per_key", "top_domains_by_count",
    "domains_alphabetical", "normalize_transaction", "is_headerless", "csv_vs_list", "canary_skip_rate",
    "advanced_search", "forward_fill_block", "keyword_table", "keyword_table_by_grams", "write_index", "upsert_index",
    "stream_upsert",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8", "spark.ui.enabled": "false",
           "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    print(json.dumps({
        "metric": "sum of median seconds per query", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": cpus,
        "spark": spark.version, "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
