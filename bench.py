"""Time the headline queries and print one JSON line.

Each query is planned, run in full into the no-op sink, and timed from the
call. The session is warmed by one unrelated aggregate; no result is cached.
"""

from __future__ import annotations

import json
import os
import time

from feedloom.catalog import QUERIES
from feedloom.session import build_session

HEADLINE = (
    "cross_geo_channel", "cross_geo_first_cat", "cross_geo_second_cat", "cross_geo_kv",
    "city_category_ctr", "geo_top_docs_channel", "geo_top_docs_kv", "geo_kv_merged",
    "geo_new_docs_channel", "local_top_comments", "nonlocal_top_likes", "hash_publish",
    "tab_doc_ctr", "tab_smoothed_ctr", "hot_tab_docs", "tab_metrics", "tab_metric_points",
    "user_sample_hashed", "feed_items", "crawl_rows", "review_enqueue", "review_payload",
    "review_labeled", "editor_weighted", "review_summary", "review_7d", "review_metric_points",
    "user_history", "index_sync_outcome", "reindex_messages",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    memory = {"spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")}
    spark = build_session("bench", f"local[{cpus}]", int(cpus), memory)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/events.parquet").groupBy("event_type").count().collect()

    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
