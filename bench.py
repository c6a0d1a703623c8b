"""Times the headline jobs and prints one JSON line.

``BENCH_SF_DIR`` names the tables (default ``/root/testdata/sf0.1``) and
``BENCH_CPUS`` the cores (default 8). Each job runs twice, the first time as a
warm-up, and always to the end of its result.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.operators.bounded import search_batch_bounded
from termloom.operators.bounds import load_bounds, save_bounds, score_bounds
from termloom.operators.build import build_index, merge_indexes
from termloom.operators.retrieve import query_terms_from_texts, search, search_batch
from termloom.plans.driver_queries import DECIMALS, QUERIES
from termloom.plans.tables import DOCUMENT_PARAMS, documents_corpus, read_table
from termloom.scratch import scratch_path
from termloom.sources.corpus import corpus_from_columns
from termloom.sources.store import load_index, save_index

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Driver queries that are timed as they are, index build included.
WHOLE_QUERIES = [
    "ingest_valid",
    "token_stream",
    "vocabulary",
    "index_merge_overlap",
    "bm25f_field_scores",
    "search_multi_term",
    "search_batch_topk",
]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("termloom-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        # Each table is a file of one row group; this spreads its rows.
        .config("termloom.read.partitions", CPUS)
        # The tables are small; this lets the adaptive planner use all cores.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(job: Callable[[], None]) -> float:
    job()
    start = time.perf_counter()
    job()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = session()
    seconds: dict[str, float] = {}

    paths = []

    def build() -> None:
        paths.append(scratch_path(spark, "bench-index"))
        save_index(build_index(documents_corpus(spark, SF_DIR)), paths[-1])

    seconds["index_build"] = timed(build)
    index = load_index(spark, paths[-1], ["text"])

    seconds["single_query_top5"] = timed(
        lambda: run(search(index, ["license", "the", "data"], DOCUMENT_PARAMS, k=5))
    )

    def batch() -> None:
        items = read_table(spark, SF_DIR, "benchmark", ["item_id", "text"])
        query = query_terms_from_texts(items, "item_id", "text")
        run(search_batch(index, query, DOCUMENT_PARAMS, k=5, decimals=DECIMALS))

    seconds["batch_query_top5"] = timed(batch)

    save_bounds(score_bounds(load_index(spark, paths[-1])), paths[-1])
    bounds = load_bounds(spark, paths[-1])

    def bounded() -> None:
        items = read_table(spark, SF_DIR, "benchmark", ["item_id", "text"])
        query = query_terms_from_texts(items, "item_id", "text")
        run(search_batch_bounded(index, bounds, query, DOCUMENT_PARAMS, k=5, decimals=DECIMALS))

    seconds["batch_bounded_top5"] = timed(bounded)

    halves = []
    documents = read_table(spark, SF_DIR, "documents", ["doc_id", "text"])
    for remainder in (0, 1):
        half = documents.where(F.coalesce(F.pmod("doc_id", F.lit(2)), F.lit(0)) == remainder)
        halves.append(scratch_path(spark, "bench-half"))
        save_index(build_index(corpus_from_columns(half, "doc_id", {"text": "text"})), halves[-1])

    def merge() -> None:
        a, b = (load_index(spark, half) for half in halves)
        save_index(merge_indexes(a, b), scratch_path(spark, "bench-merged"))

    seconds["merge_halves"] = timed(merge)

    for name in WHOLE_QUERIES:
        seconds[name] = timed(lambda: run(QUERIES[name](spark, SF_DIR)))

    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
