"""Runs the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from lodestream.plans import catalog

HEADLINE = ["url_dedup", "url_canonicalize", "page_links", "extract_text", "content_filter", "duplicate_text_demotion", "boilerplate_strip", "split_sentences", "citation_coverage", "keyword_sufficiency", "meta_compliance", "route_decision", "markdown_output", "event_windows", "relational_top_orders"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.sql.files.maxPartitionBytes", "4m").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    queries, took = catalog.queries(), {}
    spark.range(1000).selectExpr("sum(id)").collect()
    for name in HEADLINE:
        began = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
        print(name, took[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf_dir.rsplit("sf", 1)[-1], "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
