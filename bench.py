"""Time the headline queries and print one JSON line.

Reads ``BENCH_SF_DIR`` (default the sf0.1 tables) on ``local[BENCH_CPUS]``. Each query is
run once to warm the session up and then timed over its whole tables; the value is the sum.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from rankfield.plans.catalogue import QUERIES
from rankfield.plans.catalogue.retrieval import ASKED, EMBEDDER, served_table
from rankfield.plans.search import search_table

HEADLINE = [
    "knn_cosine",
    "knn_filtered",
    "knn_join",
    "ivf_full_probe",
    "mmr",
    "bm25_topk",
    "bm25_pool_count",
    "bm25_cohort_agg",
    "bm25_batch",
    "bm25_postings",
    "bm25_index_batch",
    "hash_embed",
    "semantic_topk",
    "hybrid_rrf",
    "hybrid_batch",
    "search_auto",
    "bm25_filtered",
    "hybrid_filtered",
    "load_append",
    "load_upsert",
    "load_delete",
    "sorted_layout_filter",
    "store_upsert",
    "promote_metadata",
    "join_inner",
    "group_agg",
    "window_rank",
    "column_stats",
    "table_profile",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rankfield-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Searches of indexes that were built beforehand; only the search is timed.
SERVED = {
    "served_text": {"strategy": "text"},
    "served_hybrid": {"embedder": EMBEDDER},
    "served_few_cells": {"embedder": EMBEDDER, "column": "text_embedding", "nprobe": 4},
}


def timed(spark: SparkSession, name: str, sf_dir: str, table) -> float:
    start = time.perf_counter()
    if name in SERVED:
        ask = {"column": "text", "k": 10, "columns": ["lang"]} | SERVED[name]
        found = search_table(table, ASKED, **ask)
    else:
        found = QUERIES[name](spark, sf_dir)
    found.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or [*HEADLINE, *SERVED]
    table = served_table(spark, sf_dir) if SERVED.keys() & set(names) else None
    seconds = {}
    for name in names:
        timed(spark, name, sf_dir, table)
        seconds[name] = round(timed(spark, name, sf_dir, table), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
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
    spark.stop()


if __name__ == "__main__":
    main()
