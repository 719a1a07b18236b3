"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then `BENCH_RUNS` times (default 3); the median
counts. All rows are produced and thrown away (noop sink).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time

from pyspark.sql import SparkSession

from crawlflow.catalog.queries import queries

HEADLINE = (
    "domain_extract domain_counts url_hash64 site_group time_dual publish_repair json_parse_events "
    "site_name_lookup home_split valid_interval_by_city upsert_latest_cells table_snapshot range_scan "
    "tsv_log_classify reply_explode rekey_projection dead_letter_summary website_documents "
    "ingest_snapshot stream_equals_batch ingest_forum ingest_metasearch ingest_newspaper "
    "ingest_replies ingest_webpage_home ingest_webpage ingest_weibo ingest_weibouser ingest_yixing "
    "ingest_zhimei_blog ingest_yixing_hct_mix ingest_zhimei_mix ingest_old_forum "
    "ingest_old_metasearch ingest_old_webpage ingest_old_weibo access_log_rejects person_stored "
    "website_stored dead_letters"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            registered[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(taken[1:] or taken), 4)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else folder,
            }
        )
    )


if __name__ == "__main__":
    main()
