"""Time the headline queries. Prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of local cores. The given tables are one row group each, which
one task would read; all of them, whatever their size, are first dealt into files for all cores, outside the timing.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from tarifold.queries import QUERIES
from tarifold.queries.registry import TABLES
from tarifold.session import build_session

HEADLINE = [
    "price_decision", "sku_match", "text_match", "text_match_full_titles", "batch_pricing", "import_rows", "fx_conversion", "sale_sample",
    "page_scan", "json_ld_product", "fitment_from_title", "product_links", "shopify_offers",
    "woocommerce_offers", "greedy_deduplication", "unique_handles", "clean_description", "title_terms",
    "tag_lists", "token_sort_similarity", "translation_lookup", "validated_images", "quality_flags",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "tarifold-bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    dealt = tempfile.mkdtemp(prefix="tarifold-bench-")
    for table in TABLES:
        spark.read.parquet(f"{folder}/{table}.parquet").repartition(2 * int(cpus)).write.parquet(f"{dealt}/{table}.parquet")
    times = {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        start = time.perf_counter()
        QUERIES[name](spark, dealt).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
