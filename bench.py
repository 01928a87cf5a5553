"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder with the tables, BENCH_CPUS the number of cores, BENCH_RUNS the timed runs per query
(the median is reported; one untimed run comes first), BENCH_QUERIES a comma-separated choice of queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from semstore.plans.workload import QUERIES  # noqa: E402

HEADLINE = (
    "search_cosine_topk",
    "search_filtered_topk",
    "search_euclidean",
    "rank_all_by_similarity",
    "search_batch_topk",
    "search_batch_own_filters",
    "recommend_pos_neg",
    "pair_similarity",
    "quantized_search",
    "approx_search",
    "count_filtered",
    "filter_nested",
    "filter_array_contains",
    "filter_json_payload",
    "get_by_ids",
    "upsert_latest_wins",
    "text_analysis",
    "embedding_cost",
    "embed_udf",
    "embed_hashing",
    "search_texts_batch",
    "store_pipeline",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("semstore-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="semstore-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = session(cpus)
    seconds = {}
    for name in names:
        timed(spark, folder, name)
        seconds[name] = round(statistics.median(timed(spark, folder, name) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": cpus,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
