"""Headline timings: prints one JSON line.

Runs on BENCH_SF_DIR with local[BENCH_CPUS]. Each stage is run once on the
smallest tables first, so that start-up and code generation are not counted.
The stages follow the order of a deployment: items are prepared and stored, the
pair table is built from them once, and lookups read the stored tables.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from affinia.operators.features import build_vectors
from affinia.operators.layout import partition_by_category
from affinia.operators.neighbours import similar_items, top_k_neighbours
from affinia.operators.pairs import build_index, order_edges
from affinia.operators.quality import with_violations
from affinia.operators.search import lookup, search_items
from affinia.operators.summary import count_by
from affinia.plans import bindings
from affinia.plans.item_queries import FULL_SPEC
from affinia.plans.registry import QUERIES
from affinia.sources.workspace import fresh_path, staged

THRESHOLD = 0.15
WARM = os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "testdata", "sf0.001")
REGISTERED = (
    "profiles_from_files",
    "typed_tsv_roundtrip",
    "top_k_among_copies",
    "dense_nearest",
    "token_idf",
)


def run(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def stages(spark: SparkSession, folder: str) -> dict[str, float]:
    seconds: dict[str, float] = {}

    def timed(name, work):
        start = time.perf_counter()
        result = work()
        seconds[name] = round(time.perf_counter() - start, 3)
        return result

    items = timed("build_profiles", lambda: staged(bindings.items(spark, folder), "items"))
    timed(
        "build_profiles_filtered",
        lambda: run(bindings.items(spark, folder, min_rating="5", min_votes=30)),
    )
    timed("search_items", lambda: run(search_items(items, FULL_SPEC)))
    timed("lookup_item", lambda: run(lookup(items, 42)))
    timed("count_by_array", lambda: run(count_by(items, "genres")))
    timed("quality_report", lambda: run(with_violations(items)))
    timed(
        "category_fanout",
        lambda: partition_by_category(items, fresh_path(spark, "genres"), mode="all"),
    )
    vectors = timed("build_vectors", lambda: build_vectors(items))
    index = timed("similar_pairs", lambda: build_index(vectors, THRESHOLD))
    edges = timed("write_pairs", lambda: staged(order_edges(index.edges()), "edges"))
    timed("similar_items", lambda: run(similar_items(items, edges, 42, threshold=THRESHOLD)))
    timed("top_k_neighbours", lambda: run(top_k_neighbours(index, 10, threshold=THRESHOLD)))
    for name in REGISTERED:
        query, _ = QUERIES[name]
        timed(name, lambda query=query: run(query(spark, folder)))
    return seconds


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("affinia-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if os.path.isdir(WARM):
        stages(spark, WARM)
    seconds = stages(spark, folder)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
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
